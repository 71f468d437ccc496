"""A training corpus from raw documents, in five stages over whole tables.

Language identification drops texts in no learned language, line dedup deletes lines that
occur earlier, SimHash leaves one document of each group of near copies, mixing draws the sources
to their target weights, and BPE turns the texts into token ids.

A stage takes (spark, docs, folder) and returns the documents it keeps, with the columns
of `documents`; the last returns one row of token digests for each drawn document. A
document whose lines are all deleted is dropped. Cut texts get their new length in
n_chars. Every stage allows nulls in any column, repeated rows, further columns and an
empty table.
"""

from pyspark.sql import functions as F

from wavelode.llm.bpe import encode
from wavelode.llm.common import discard, documents, named, stored
from wavelode.llm.langid import keep_identified
from wavelode.llm.lines import dedup_lines
from wavelode.llm.mixing import mixed_documents
from wavelode.llm.queries import token_digests, word_vocabulary
from wavelode.llm.simhash import keep_one


def _measured(docs):
    """n_chars of the texts as they are now, where there is such a column."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def identify(spark, docs, folder):
    return keep_identified(docs)


def dedup_repeated_lines(spark, docs, folder):
    removed = max(docs.columns, key=len) + "_removed"  # no column of the table
    found = dedup_lines(docs, removed=removed)
    left = (F.size(named(removed)) == 0) | F.col("text").rlike(r"\S")
    return _measured(found.where(left).select(*[named(c) for c in docs.columns]))


def dedup_near_copies(spark, docs, folder):
    return keep_one(docs)


def mix(spark, docs, folder):
    return _measured(mixed_documents(docs))


def tokenize(spark, docs, folder):
    return token_digests(encode(docs, word_vocabulary(), decoded=True))


STAGES = [
    ("language_id", identify),
    ("line_dedup", dedup_repeated_lines),
    ("simhash_near_dedup", dedup_near_copies),
    ("mixing", mix),
    ("bpe", tokenize),
]

# Cross-parsing, SimHash over XXH64 and BPE have no DuckDB SQL; the stages are tested
# against brute-force versions.
ORACLE_SQL = None


def run(spark, folder):
    """The rows of the last stage over the whole table of documents."""
    docs, before = documents(spark, folder), None
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, folder), name)
        if before is not None:  # its last reader is done
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, folder)
