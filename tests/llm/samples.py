"""Small document tables with the cases that every operator has to stand."""

import os
import random

import duckdb

TESTDATA = os.environ.get("TESTDATA", "/root/testdata")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"

LONG = " ".join(f"word{n % 977} other{n % 31}" for n in range(60_000))


def row(doc_id, text, lang="en", source="a"):
    return doc_id, text, lang, source, None if text is None else len(text)


def odd_rows():
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    return [
        row(5, "The same text in two rows."), row(5, "The same text in two rows."),
        row(6, "The same text in two rows."), row(None, "The same text in two rows."),
        row(None, None, None, None), row(None, None, None, None),
        row(7, None, "de", None), row(8, "", None, "b"), row(9, "   \n\t\n ", "de", "b"),
        row(10, LONG, "en", "a"), row(11, LONG, "en", "b"),
        row(12, "12345 !!! 678", "fr", "c"), row(13, "\U0001f600 Ünïcode ÀÉ İΣ", "fr", "c"),
        row(14, "a", "de", "c"), row(-3, "token = 'abcdefgh12345678'", None, "c"),
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def clashing(docs):
    """The table with further columns named like those that operators make."""
    from pyspark.sql import functions as F

    names = ["id", "key", "size", "hash", "text_", "_text", "_id", "_hash", "removed", "score",
             "lang_pred", "component_id", "row", "draws", "spans", "slot", "shard", "c0", "print",
             "keep_id", "kept", "block", "order", "target", "taken", "label", "fingerprint",
             "meta.url", "text.", "a`b"]
    return docs.select("*", *[F.lit(n).alias(n) for n in names])


def words(rng, least, most, letters="abcdefghijklmnop"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7)))
                    for _ in range(rng.randint(least, most)))


def near_copies(seed=3):
    """Documents with exact copies, small edits and unrelated texts."""
    rng = random.Random(seed)
    rows, number = [], 100
    for group in range(25):
        base = words(rng, 150, 400).split()
        for copy in range(rng.choice([1, 1, 2, 4, 9])):
            text = list(base)
            for _ in range(rng.choice([0, 1, 1, 2])):
                text[rng.randrange(len(text))] = words(rng, 1, 1)
            rows.append(row(number, " ".join(text), "en", f"s{group % 4}"))
            number += 1
    rng.shuffle(rows)
    return rows


def documents_of(name="sf0.001"):
    query = f"SELECT doc_id, text, lang, source, n_chars FROM '{TESTDATA}/{name}/documents.parquet'"
    return duckdb.sql(query + " ORDER BY doc_id").fetchall()
