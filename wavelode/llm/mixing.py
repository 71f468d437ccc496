"""Mix sources to target weights with a multivariate-hypergeometric splitting tree.

1. A source is cut into blocks by the hash of its rows; with sqrt(rows) blocks a block
   and the list of a source's blocks both stay small, whatever the source's share.
2. A source's quota is its target in words: so many whole passes over its blocks and a
   part of one more pass, in block order permuted anew for each pass. The last block is
   cut at the word where the target is reached, so the quota is met exactly.
3. A tree splits the block quotas of all sources among the output shards: each node
   hands a half of its blocks to its left child, with the numbers by source drawn from
   the multivariate hypergeometric distribution. Every block lands in one shard, and
   every shard is a random sample of the mix.
4. A shard takes its number of blocks from each source's permuted list, no block twice,
   and orders its own documents by hash.

Only sizes and hashes are handled until the last join. All numbers come from hashes, so
a rerun draws the same mix.
"""

import math
from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from wavelode.llm.common import WORD, named, plain_text, stored, whole_row

SHARDS = 16
SEED = 20
# No document is taken more often than this.
MOST_PASSES = 3


def _number(*parts):
    """60 bits of an MD5 over the parts: an order that SQL elsewhere can repeat."""
    joined = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(joined), 1, 15), 16, 10).cast("bigint")


def word_count(text):
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def source_targets(sizes, most=MOST_PASSES):
    """Targets by source from rows (source, source_size), in words.

    Sources in code-point order, null last, weigh 1, 2, 3 and so on in turn, and share
    the sum of all sizes by weight. A target stops at `most` times its source's size
    and the excess is shared anew by weight, until none is above: a target is the
    lesser of that bound and weight * level, for one level common to all. Sources
    sorted by bound / weight reach their bound in that order, which gives the level
    without iterating. There is one row of numbers per source here, which one task sorts.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy().rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    by_ratio = Window.orderBy("ratio", "place")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = (
        sizes.withColumn("place", F.row_number().over(by_name))
        .withColumn("weight", (F.col("place") - 1) % 3 + 1)
        .withColumn("bound", F.col("source_size") * most)
        .withColumn("ratio", F.col("bound") / F.col("weight"))
        .withColumn(
            "level",
            (F.sum("source_size").over(everything)
             - F.coalesce(F.sum("bound").over(before), F.lit(0)))
            / F.sum("weight").over(after),
        )
        .withColumn("turn", F.row_number().over(by_ratio))
    )
    level = F.min_by("level", F.when(F.col("ratio") > F.col("level"), F.col("turn")))
    rows = rows.withColumn("final", level.over(everything))
    share = F.col("weight") * F.col("final")
    bound = F.col("bound").cast("double")
    return rows.withColumn("target", F.coalesce(F.least(bound, share), bound)).select(
        "source", "place", "source_size", "target"
    )


def _hypergeometric(total, marked, drawn, uniform):
    """SQL for the number of marked among `drawn` of `total`, from a uniform number.

    Inversion over the support in the order mode, mode + 1, ..., mode - 1, ..., with
    weights relative to the mode. Values more than ten standard deviations away are
    left out: they are below the resolution of a double.
    """
    up = ("((v.marked - k) * (v.drawn - k)"
          " / ((k + 1) * (v.total - v.marked - v.drawn + k + 1)))")
    down = ("(k * (v.total - v.marked - v.drawn + k)"
            " / ((v.marked - k + 1) * (v.drawn - k + 1)))")
    ups = "if(v.top > v.mode, sequence(v.mode, v.top - 1), cast(array() as array<bigint>))"
    downs = ("if(v.mode > v.bottom, sequence(v.mode, v.bottom + 1, -1L),"
             " cast(array() as array<bigint>))")

    def weights(ks, ratio):
        return (f"aggregate({ks}, named_struct('w', 1D, 'sum', 0D), (a, k) -> named_struct("
                f"'w', a.w * {ratio}, 'sum', a.sum + a.w * {ratio}), a -> a.sum)")

    def search(ks, ratio, start, value):
        return (f"aggregate({ks}, {start}, (a, k) -> if(a.found is not null, a, named_struct("
                f"'w', a.w * {ratio}, 'sum', a.sum + a.w * {ratio},"
                f" 'found', if(a.sum + a.w * {ratio} >= v.goal, {value}, null))))")

    first = ("named_struct('w', 1D, 'sum', 1D,"
             " 'found', if(1D >= v.goal, v.mode, cast(null as bigint)))")
    upward = search(ups, up, first, "k + 1")
    downward = search(downs, down, "named_struct('w', 1D, 'sum', u.sum, 'found', u.found)", "k - 1")
    return f"""
        transform(array(named_struct(
            'total', cast({total} as double), 'marked', cast({marked} as double),
            'drawn', cast({drawn} as double), 'uniform', {uniform},
            'low', greatest(0L, {drawn} - ({total} - {marked})),
            'high', least({marked}, {drawn}))),
        v -> transform(array(named_struct(
            'total', v.total, 'marked', v.marked, 'drawn', v.drawn, 'uniform', v.uniform,
            'low', v.low, 'high', v.high,
            'mode', least(v.high, greatest(v.low, cast(floor(
                (v.drawn + 1) * (v.marked + 1) / (v.total + 2)) as bigint))),
            'reach', cast(ceil(10 * sqrt(greatest(0D, v.drawn * v.marked / greatest(v.total, 1D)
                * (v.total - v.marked) / greatest(v.total, 1D)
                * (v.total - v.drawn) / greatest(v.total - 1, 1D)))) as bigint) + 10)),
        v -> transform(array(named_struct(
            'total', v.total, 'marked', v.marked, 'drawn', v.drawn, 'uniform', v.uniform,
            'mode', v.mode, 'bottom', greatest(v.low, v.mode - v.reach),
            'top', least(v.high, v.mode + v.reach))),
        v -> transform(array(named_struct(
            'total', v.total, 'marked', v.marked, 'drawn', v.drawn,
            'mode', v.mode, 'bottom', v.bottom, 'top', v.top,
            'goal', v.uniform * (1D + {weights(ups, up)} + {weights(downs, down)}))),
        v -> transform(array({upward}),
        u -> coalesce({downward}.found, v.bottom, v.mode))[0])[0])[0])[0])[0]"""


def _split(seed):
    """SQL: the blocks of each of a node's sources that its left child draws, `drawn` in all."""
    draw = _hypergeometric(
        "s.total", "counts[i]", "s.drawn",
        f"shiftrightunsigned(xxhash64({seed}, part, first, width, i), 11) * pow(2D, -53D)",
    )
    return f"""
        aggregate(
            sequence(0, size(counts) - 1),
            named_struct(
                'total', aggregate(counts, 0L, (a, c) -> a + c),
                'drawn', drawn, 'out', cast(array() as array<bigint>)),
            (s, i) -> transform(array({draw}), x -> named_struct(
                'total', s.total - counts[i], 'drawn', s.drawn - x,
                'out', concat(s.out, array(x))))[0],
            s -> s.out)"""


_CHILDREN = """array(
    named_struct('first', first, 'width', width div 2, 'counts', left),
    named_struct('first', first + width div 2, 'width', width - width div 2,
                 'counts', zip_with(counts, left, (a, b) -> a - b)))"""


def _descend(quotas, shards, seed, part_sources):
    """The tree over quotas (place, blocks): its leaves (shard, place, blocks), and the draws
    (first, width, place, left) of its inner nodes.

    A row holds a node's counts of up to `part_sources` sources. With more of them, the draws
    of each part as a whole come from a tree over the parts' totals, and a part is drawn from
    by what was drawn of it: that gives the same distribution as drawing from all at once.
    """
    part = F.floor(F.col("place") / part_sources).cast("bigint")
    quotas = stored(quotas, "mix-quotas")
    parents = None
    if quotas.select(part.alias("part")).distinct().count() > 1:
        totals = quotas.groupBy(part.alias("place")).agg(F.sum("blocks").alias("blocks"))
        parents = _descend(totals, shards, seed + 1, part_sources)[1].select(
            F.col("place").alias("part"), "first", "width", F.col("left").alias("drawn"))
    nodes = quotas.groupBy(part.alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("place", "blocks"))).alias("q")
    ).select("part", F.lit(0).alias("first"), F.lit(shards).alias("width"),
             F.col("q.place").alias("places"), F.col("q.blocks").alias("counts"))
    half = F.expr("aggregate(counts, 0L, (a, c) -> a + c) * (width div 2) div width")
    leaves, draws = [], []
    for _ in range(math.ceil(math.log2(shards)) if shards > 1 else 0):
        leaves.append(nodes.where("width = 1"))
        inner = nodes.where("width > 1")
        inner = inner.withColumn("drawn", half) if parents is None else inner.join(
            parents, ["part", "first", "width"])
        inner = inner.withColumn("left", F.expr(_split(seed)))
        draws.append(inner.select("first", "width", F.explode(
            F.arrays_zip("places", "left")).alias("d")).select(
                "first", "width", F.col("d.places").alias("place"), F.col("d.left").alias("left")))
        nodes = inner.select("part", "places", F.explode(F.expr(_CHILDREN)).alias("node")).select(
            "part", "node.first", "node.width", "places", "node.counts")
    leaves.append(nodes)

    def together(frames):
        return reduce(lambda a, b: a.unionByName(b), frames) if frames else None

    pairs = together(leaves).select(F.col("first").alias("shard"), F.explode(
        F.arrays_zip("places", "counts")).alias("d"))
    found = pairs.select("shard", F.col("d.places").alias("place"), F.col("d.counts").alias("blocks"))
    draws = together(draws)
    return found, draws


# Sources whose counts share a row of the tree.
PART_SOURCES = 512


def split_quotas(quotas, shards, seed=SEED, part_sources=PART_SOURCES):
    """Rows (shard, place, blocks) from quotas (place, blocks) by the splitting tree.

    A node covers shards first..first + width - 1; there are log2(shards) levels. Any
    number of sources will do: no row holds more than `part_sources` of them.
    """
    return _descend(quotas, shards, seed, part_sources)[0].where("blocks > 0")


def mix_sources(docs, id_col="doc_id", text_col="text", source_col="source",
                shards=SHARDS, seed=SEED, carry=()):
    """Draw a mix of the documents. One row per input row:

    `id_col`, size (words), source_size, target (its source's, in words), taken (words
    the mix takes, repeats counted) and draws, an array of (shard, pass, words, place):
    the shard that gets the document, how many of its words, and its place in the
    shard's own order. Columns named in `carry` are kept too.

    A null text has no words and is never drawn; a null source is one source, after all
    others. Rows may repeat: each is drawn on its own. Null ids are allowed. Sizes and
    targets are 0 where there are no words at all. An empty table gives no rows. Other
    columns are not read, whatever their names.
    """
    text = plain_text(text_col)
    key = F.coalesce(F.concat(F.lit("s"), F.col(source_col)), F.lit("n"))
    carried = {f"_c{n}": named(c) for n, c in enumerate(carry)}
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), key.alias("key"),
        word_count(text).alias("size"), F.md5(text).alias("content"),
        *[c.alias(name) for name, c in carried.items()],
    )
    # Sizes once for all later steps; with carried columns the last step reads docs again.
    sizes = stored(rows.drop(*carried), "mix-sizes")
    blocks_each = max(1, math.ceil(math.sqrt(sizes.count())))

    def placed(frame):
        row = F.col("id"), F.col("content")
        return frame.withColumn("block", _number(F.lit(seed), *row) % blocks_each).withColumn(
            "order", _number(F.lit(seed + 1), *row))

    blocks = stored(
        placed(sizes).groupBy("key", "block").agg(
            F.sum("size").alias("words"), F.first("source").alias("source")),
        "mix-blocks",
    )
    totals = blocks.groupBy("key").agg(
        F.sum("words").alias("source_size"), F.first("source").alias("source"))
    targets = stored(
        source_targets(totals.drop("key")).withColumn(
            "key", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))).drop("source"),
        "mix-targets",
    )
    blocks = blocks.drop("source").join(targets, "key")

    # Quotas: block instances by pass, in an order permuted anew for each pass.
    passes = F.explode(F.sequence(F.lit(0), F.lit(MOST_PASSES - 1))).alias("pass")
    turn = Window.partitionBy("key", "pass").orderBy("shuffled", "block")
    words_before = F.sum("words").over(turn) - F.col("words")
    left = (F.round("target").cast("bigint") - F.col("pass") * F.col("source_size")
            - words_before)
    in_order = Window.partitionBy("key").orderBy("pass", "shuffled", "block")
    instances = stored(
        blocks.where("words > 0").select("*", passes)
        .withColumn("shuffled", _number(
            F.lit(seed + 2), F.col("key"), F.col("block"), F.col("pass")))
        .withColumn("limit", F.least(F.col("words"), left)).where("limit > 0")
        .withColumn("rank", F.row_number().over(in_order))
        .select("key", "place", "block", "pass", "limit", "rank"),
        "mix-instances",
    )

    quotas = instances.groupBy("place").agg(F.count(F.lit(1)).alias("blocks"))
    shares = stored(split_quotas(quotas, shards, seed), "mix-shares")
    by_shard = Window.partitionBy("place").orderBy("shard")
    drawn = (
        shares.withColumn("end", F.sum("blocks").over(by_shard))
        .select("place", "shard",
                F.explode(F.expr("sequence(end - blocks + 1, end)")).alias("rank"))
    )
    by_block = instances.join(drawn, ["place", "rank"]).groupBy("key", "block").agg(
        F.sort_array(F.collect_list(F.struct("pass", "shard", "limit"))).alias("takes"))
    plan = blocks.select("key", "block", "source_size", "target").join(
        by_block, ["key", "block"], "left")

    in_block = Window.partitionBy("key", "block").orderBy("order", "id", "content", "size")
    source_rows = placed(rows if carried else sizes)
    before = F.sum("size").over(in_block) - F.col("size")
    result = source_rows.withColumn("before", before).join(plan, ["key", "block"])
    draws = F.expr(f"""
        filter(transform(coalesce(takes, array()), t -> named_struct(
            'shard', t.shard, 'pass', t.pass,
            'words', greatest(0L, least(size, t.limit - before)),
            'place', xxhash64({seed + 3}, t.shard, t.pass, id, content))), d -> d.words > 0)""")
    return result.withColumn("draws", draws).select(
        F.col("id").alias(id_col), "size", "source_size", "target",
        F.expr("aggregate(draws, 0L, (a, d) -> a + d.words)").alias("taken"), "draws",
        *[F.col(name).alias(c) for name, c in zip(carried, carry)],
    )


def first_words(text, words):
    """The text up to the end of its first so many words."""
    pieces = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    return F.array_join(F.slice(pieces, F.lit(1), words.cast("int")), "")


def mixed_documents(docs, id_col="doc_id", text_col="text", source_col="source",
                    shards=SHARDS, seed=SEED):
    """The documents of the mix with all their columns: a row for each time a document is
    taken, the text cut after the words that are taken. Shards follow one another, each in
    its own order and in as many partitions as the others; rows without words are not
    taken."""
    rows = docs.select(whole_row(docs).alias("row"), named(id_col).alias("id"),
                       named(text_col).alias("text"), named(source_col).alias("source"))
    mix = mix_sources(rows, "id", "text", "source", shards, seed, carry=["row"])
    taken = mix.select("row", "size", F.explode("draws").alias("draw"))
    text = F.col("row")[text_col]
    cut = F.when(F.col("draw.words") < F.col("size"), first_words(text, F.col("draw.words")))
    # Places are hashes, so equal ranges of them hold about as many documents.
    each = math.ceil(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) / shards)
    within = F.floor((F.shiftright("draw.place", 32) + 2**31) * each / 2**32)
    part = (F.col("draw.shard") * each + within).cast("int")
    ordered = taken.repartitionById(shards * each, part).sortWithinPartitions(
        "draw.shard", "draw.place", "draw.pass")
    return ordered.select(
        F.col("row").withField(f"`{text_col}`", F.coalesce(cut, text)).alias("row")
    ).select("row.*")
