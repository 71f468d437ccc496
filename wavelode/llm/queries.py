"""The registered query of each operator, with its SQL where SQL can express it."""

from pyspark.sql import functions as F

from wavelode.llm.bpe import encode
from wavelode.llm.clustering import CLUSTERS, DIMENSIONS, ROUNDS, cluster_vectors
from wavelode.llm.common import WORD, documents
from wavelode.llm.exact_dedup import exact_duplicates
from wavelode.llm.fim import RATE, SPM_RATE, digests, fill_in_middle
from wavelode.llm.fim import SEED as FIM_SEED
from wavelode.llm.fingerprints import compare_with_next
from wavelode.llm.langid import predict_languages
from wavelode.llm.lines import dedup_lines
from wavelode.llm.mixing import MOST_PASSES, SEED, mix_sources
from wavelode.llm.secret_scan import KINDS, scan_secrets
from wavelode.llm.sharding import SHARDS, SLOTS, place
from wavelode.llm.simhash import near_duplicates
from wavelode.llm.substrings import LEAST, dedup_passages
from wavelode.llm.toxicity import score_toxicity

QUERIES = {}
SQL = {}


def query(name, sql=None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


@query("op1_toxicity")
def op1_toxicity(spark, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return score_toxicity(documents(spark, folder), labels)


@query("op2_secret_scan")
def op2_secret_scan(spark, folder):
    def joined(spans):
        return F.array_join(
            F.expr(f"transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end))"), ",")

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    return scan_secrets(documents(spark, folder)).select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"),
    )


@query("op3_mixing", f"""
    WITH sizes AS (
        SELECT doc_id, source, coalesce('s' || source, 'n') AS key, md5(coalesce(text, '')) AS content,
               len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size
        FROM documents
    ),
    placed AS (
        SELECT *,
               ('0x' || substr(md5(concat_ws('|', '{SEED}', coalesce(doc_id::VARCHAR, ''), content)),
                               1, 15))::BIGINT
                   % greatest(1, ceil(sqrt((SELECT count(*) FROM sizes))))::BIGINT AS block,
               ('0x' || substr(md5(concat_ws('|', '{SEED + 1}', coalesce(doc_id::VARCHAR, ''),
                                             content)), 1, 15))::BIGINT AS turn
        FROM sizes
    ),
    sources AS (
        SELECT key, source, sum(size)::BIGINT AS source_size,
               (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
        FROM sizes GROUP BY key, source
    ),
    levels AS (
        SELECT *, source_size * {MOST_PASSES} AS bound,
               source_size * {MOST_PASSES} / weight AS ratio,
               (sum(source_size) OVER ()
                - coalesce(sum(source_size * {MOST_PASSES}) OVER (
                      ORDER BY source_size * {MOST_PASSES} / weight, source NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
               / (sum(weight) OVER (
                      ORDER BY source_size * {MOST_PASSES} / weight, source NULLS LAST
                      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
        FROM sources
    ),
    targets AS (
        SELECT *, coalesce(least(bound, weight * (
                   SELECT arg_min(level, ratio) FROM levels WHERE ratio > level)), bound)::DOUBLE
               AS target
        FROM levels
    ),
    blocks AS (
        SELECT key, block, sum(size)::BIGINT AS words, pass
        FROM placed, range({MOST_PASSES}) p(pass) GROUP BY key, block, pass
    ),
    passes AS (
        SELECT b.key, b.block, b.pass,
               least(words, round(target)::BIGINT - pass * source_size
                     - (sum(words) OVER (
                           PARTITION BY b.key, b.pass
                           ORDER BY ('0x' || substr(md5(concat_ws('|', '{SEED + 2}', b.key,
                                     b.block::VARCHAR, b.pass::VARCHAR)), 1, 15))::BIGINT, b.block)
                        - words)) AS most
        FROM blocks b JOIN targets USING (key)
        WHERE words > 0
    ),
    cut AS (
        SELECT *, sum(size) OVER (PARTITION BY key, block ORDER BY turn, doc_id, content) - size
                  AS before
        FROM placed
    )
    SELECT c.doc_id, any_value(c.size) AS size, any_value(t.source_size) AS source_size,
           any_value(t.target) AS target,
           coalesce(sum(greatest(0, least(c.size, p.most - c.before)))
                    FILTER (p.most IS NOT NULL), 0)::BIGINT AS taken
    FROM cut c JOIN targets t USING (key)
    LEFT JOIN passes p ON p.key = c.key AND p.block = c.block AND p.most > 0
    GROUP BY c.doc_id, c.content
""")
def op3_mixing(spark, folder):
    mix = mix_sources(documents(spark, folder))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


@query("op4_language_id")
def op4_language_id(spark, folder):
    return predict_languages(documents(spark, folder))


# White space as Python's strip() knows it.
_BLANK = (r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}"
          r"\x{202F}\x{205F}\x{3000}")


@query("op5_line_dedup", f"""
    WITH texts AS (
        SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
    ),
    lines AS (
        SELECT doc_id, n AS place, regexp_replace(lines[n + 1], '^[{_BLANK}]+|[{_BLANK}]+$', '', 'g')
                   AS line
        FROM texts, unnest(range(len(lines))) AS u(n)
    ),
    later AS (
        SELECT doc_id, place, place - row_number() OVER (PARTITION BY doc_id ORDER BY place) AS island
        FROM (SELECT *, row_number() OVER (PARTITION BY line ORDER BY doc_id, place) AS turn
              FROM lines WHERE line <> '')
        WHERE turn > 1
    ),
    spans AS (
        SELECT doc_id, min(place) AS first, max(place) AS last FROM later GROUP BY doc_id, island
    ),
    gone AS (
        SELECT doc_id, sum(last - first + 1)::BIGINT AS n_removed,
               string_agg(first || '-' || last, ',' ORDER BY first) AS removed
        FROM spans GROUP BY doc_id
    ),
    places AS (SELECT doc_id, list(place) AS places FROM later GROUP BY doc_id)
    SELECT t.doc_id, len(t.lines)::BIGINT AS n_lines, coalesce(g.n_removed, 0) AS n_removed,
           coalesce(g.removed, '') AS removed,
           sha256(coalesce(array_to_string(CASE WHEN p.places IS NULL THEN t.lines ELSE list_filter(
               t.lines, lambda s, i: NOT list_contains(p.places, i - 1)) END, chr(10)), ''))
               AS text_sha256
    FROM texts t LEFT JOIN gone g USING (doc_id) LEFT JOIN places p USING (doc_id)
""")
def op5_line_dedup(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text", F.size(
        F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("bigint").alias("n_lines"))
    return dedup_lines(docs).select(
        "doc_id", "n_lines",
        F.expr("aggregate(removed, 0L, (a, s) -> a + s.end - s.start + 1)").alias("n_removed"),
        F.array_join(F.expr("transform(removed, s -> s.start || '-' || s.end)"), ",").alias("removed"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
    )


@query("op6_exact_dedup", """
    SELECT doc_id,
           max(doc_id) OVER same AS keep_id,
           count(*) OVER same AS group_size,
           row_number() OVER (PARTITION BY coalesce(text, '')
                              ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
           sha256(coalesce(text, '')) AS text_sha256
    FROM documents
    WINDOW same AS (PARTITION BY coalesce(text, ''))
""")
def op6_exact_dedup(spark, folder):
    return exact_duplicates(documents(spark, folder), digest_all=True)


@query("op7_fingerprints")
def op7_fingerprints(spark, folder):
    return compare_with_next(documents(spark, folder)).drop("positions")


@query("op8_simhash_near_dedup")
def op8_simhash_near_dedup(spark, folder):
    return near_duplicates(documents(spark, folder))


def token_digests(encoded):
    """Numbers of tokens and SHA-256 of ids and decoded text."""
    return encoded.select(
        "doc_id", (F.octet_length("token_ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def word_vocabulary():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op9_bpe")
def op9_bpe(spark, folder):
    return token_digests(encode(documents(spark, folder), word_vocabulary(), decoded=True))


@query("op10_sharding", f"""
    WITH RECURSIVE
    shards AS (
        SELECT i,
               ('0x' || substr(md5('shard-' || i || ':offset'), 1, 8))::BIGINT % {SLOTS} AS start,
               ('0x' || substr(md5('shard-' || i || ':skip'), 1, 8))::BIGINT % {SLOTS - 1} + 1
                   AS skip
        FROM range({SHARDS}) t(i)
    ),
    orders AS (
        SELECT i, list((start + j * skip) % {SLOTS} ORDER BY j) AS wish
        FROM shards, range({SLOTS}) u(j) GROUP BY i
    ),
    turns AS (
        SELECT 0 AS turn, -1::BIGINT AS slot, list_transform(range({SLOTS}), lambda x: true) AS open
        UNION ALL
        SELECT turn + 1, pick,
               open[:pick] || [false] || open[pick + 2:]
        FROM (
            SELECT t.turn, t.open, list_filter(o.wish, lambda x: t.open[x + 1])[1] AS pick
            FROM turns t JOIN orders o ON o.i = t.turn % {SHARDS}
            WHERE t.turn < {SLOTS}
        )
    ),
    filled AS (
        SELECT slot::INT AS slot, ((turn - 1) % {SHARDS})::INT AS shard
        FROM turns WHERE turn > 0
    )
    SELECT d.doc_id, f.slot, f.shard
    FROM (
        SELECT doc_id,
               ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT % {SLOTS} AS slot
        FROM documents
    ) d JOIN filled f USING (slot)
""")
def op10_sharding(spark, folder):
    docs = documents(spark, folder).select("doc_id")
    return place(docs, "doc_id").select("doc_id", "slot", "shard")


@query("op11_fill_in_middle", f"""
    WITH draws AS (
        SELECT doc_id, coalesce(text, '') AS text,
               regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS units,
               sha256('{FIM_SEED}:' || coalesce(doc_id::VARCHAR, '')) AS hash
        FROM documents
    ),
    cuts AS (
        SELECT *, len(units)::BIGINT AS n,
               list_transform([1, 9, 17, 25], lambda i: ('0x' || substr(hash, i, 8))::BIGINT) AS h
        FROM draws
    ),
    forms AS (
        SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS low,
               greatest(h[1] % (n + 1), h[2] % (n + 1)) AS high,
               CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                         OR contains(text, '<M>') OR h[3] % 100 >= {RATE} THEN 'plain'
                    WHEN h[4] % 100 < {SPM_RATE} THEN 'spm' ELSE 'psm' END AS form
        FROM cuts
    ),
    sections AS (
        SELECT doc_id, n, form, text,
               coalesce(array_to_string(units[1:low], ''), '') AS prefix,
               coalesce(array_to_string(units[low + 1:high], ''), '') AS middle,
               coalesce(array_to_string(units[high + 1:], ''), '') AS suffix
        FROM forms
    )
    SELECT doc_id, n, form,
           CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text
                            WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                            ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END)
               AS output_sha256,
           sha256(text) AS restored_sha256
    FROM sections
""")
def op11_fill_in_middle(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text")
    return digests(fill_in_middle(docs))


@query("op12_substring_dedup", f"""
    WITH tokens AS (
        SELECT row_number() OVER () AS row, doc_id,
               regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
        FROM documents
    ),
    windows AS (
        SELECT row, doc_id, start, md5(array_to_string(words[start:start + {LEAST - 1}], ' ')) AS hash
        FROM tokens, unnest(range(1, len(words) - {LEAST - 2})) AS u(start)
    ),
    later AS (
        SELECT row, start
        FROM (SELECT *, min(doc_id) OVER (PARTITION BY hash) AS first FROM windows)
        WHERE doc_id > first
    ),
    lost AS (
        SELECT DISTINCT row, start + i AS place FROM later, range({LEAST}) AS r(i)
    ),
    gone AS (SELECT row, list(place) AS places FROM lost GROUP BY row),
    kept AS (
        SELECT t.doc_id, t.words, coalesce(g.places, []) AS places
        FROM tokens t LEFT JOIN gone g USING (row)
    )
    SELECT doc_id, len(words)::BIGINT AS n_words, len(places)::BIGINT AS n_removed,
           sha256(coalesce(array_to_string(CASE WHEN len(places) = 0 THEN words ELSE
               list_filter(words, lambda w, i: NOT list_contains(places, i)) END, ' '), ''))
               AS kept_sha256
    FROM kept
""")
def op12_substring_dedup(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text")

    def words(column):
        return F.regexp_extract_all(F.coalesce(column, F.lit("")), F.lit(WORD), F.lit(0))

    found = dedup_passages(docs).select("doc_id", words("text").alias("kept"), F.expr(
        "aggregate(removed, 0L, (a, s) -> a + s.end - s.start)").alias("n_removed"))
    return found.select(
        "doc_id", (F.size("kept") + F.col("n_removed")).alias("n_words"), "n_removed",
        F.sha2(F.array_join("kept", " "), 256).alias("kept_sha256"))


def _clustering_sql():
    """Assignment and new centroids of each round, one after another."""
    def assigned(number):
        return f"""assigned{number} AS MATERIALIZED (
            SELECT vec_id, x, unnest(best) FROM (
                SELECT v.vec_id, v.row, any_value(v.x) AS x, min(struct_pack(
                    distance := list_sum(list_transform(list_zip(v.x, c.x),
                                         lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT,
                    cluster := c.cluster)) AS best
                FROM kept v, centroids{number} c GROUP BY v.vec_id, v.row))"""

    def moved(number):
        return f"""means{number} AS (
            SELECT cluster, list(floor_mean ORDER BY i) AS x FROM (
                SELECT cluster, i, ((s - ((s % n) + n) % n) // n)::BIGINT AS floor_mean FROM (
                    SELECT cluster, i, sum(x[i])::BIGINT AS s, count(*) AS n
                    FROM assigned{number}, range(1, {DIMENSIONS + 1}) r(i) GROUP BY cluster, i))
            GROUP BY cluster),
        centroids{number + 1} AS MATERIALIZED (
            SELECT c.cluster, coalesce(m.x, c.x) AS x
            FROM centroids{number} c LEFT JOIN means{number} m USING (cluster))"""

    steps = [part for n in range(ROUNDS) for part in (assigned(n), moved(n))]
    return f"""
    WITH kept AS MATERIALIZED (
        SELECT vec_id, row_number() OVER () AS row,
               list_transform(embedding, lambda e: floor(64 * e::DOUBLE)::BIGINT) AS x
        FROM embeddings
        WHERE len(embedding) = {DIMENSIONS}
          AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {DIMENSIONS}
    ),
    centroids0 AS MATERIALIZED (
        SELECT (row_number() OVER (ORDER BY hash, x) - 1)::INT AS cluster, x
        FROM (SELECT sha256('1:' || coalesce(vec_id::VARCHAR, '')) AS hash, x FROM kept)
        ORDER BY hash, x LIMIT {CLUSTERS}
    ),
    {", ".join([*steps, assigned(ROUNDS)])}
    SELECT a.vec_id, a.cluster, a.distance,
           (sum(a.distance) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia,
           (sum(a.distance) OVER ())::BIGINT AS inertia,
           sha256(array_to_string(c.x, ',')) AS centroid_sha256
    FROM assigned{ROUNDS} a JOIN centroids{ROUNDS} c USING (cluster)
    """


@query("op13_centroid_clustering", _clustering_sql())
def op13_centroid_clustering(spark, folder):
    return cluster_vectors(spark.read.parquet(f"{folder}/embeddings.parquet"))
