"""Document fingerprints: SimHash, and a search of all fingerprints within a Hamming radius.

Terms are adjacent word pairs (A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``; the first word is
also paired with nothing before it), weighing the length of their second word. A term has a hash
of 128 bits; each bit votes with the term's weight for 1 or against, and the fingerprint holds the
bits that win more than half. Two counters of 32 bits share a long, so 64 sums count all votes in
one aggregate. The likeness of two fingerprints is the cosine that the share of differing bits
estimates, at least 0.

Everything is Spark SQL functions: no Python meets a row.

The search keeps fingerprints in block tables: the bits are cut into ``radius + kept`` blocks, and
for each choice of ``kept`` blocks there is a table keyed by them. Two fingerprints within the
radius differ in at most ``radius`` blocks, so they agree on all blocks of some table; the pair is
counted in the first such table alone. ``kept`` follows the numbers of fingerprints by cost. Equal
fingerprints are one entry; the entries of a key are met in cells of bounded size.

Null texts count as empty. Texts without words have the fingerprint 0. The order of documents is
by descending id, null ids last, rows that share an id by digest; rows that repeat both id and
text are one document there and get equal rows. Extra columns are not read; empty tables give an
empty result.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import SPACE_RUN, exact_digest, stage

BITS = 128
RADIUS = 6
CELL = 512
#: Copies of one row are written by tasks of at most this many rows each.
COPIES = 4096
#: Fingerprints that are joined by broadcast at most: those of more than this share of one of the queries.
HEAVY_KEYS = 1000
_LANES = 0x0000000100000001  # bits i and i + 32 of a hash, each in a counter of 32 bits
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def terms(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys, a, b, weight``: a row per term with its hash of 128 bits. White space at either end
    leaves an empty word, and every text one row without a word; neither weighs anything, so every
    text has a row."""
    words = F.split(F.translate(F.col(text), _UPPER, _LOWER), SPACE_RUN)
    listed = rows.select(*keys, words.alias("words"))
    before = F.concat(F.array(F.lit("")), F.col("words"))
    pairs = listed.select(*keys, F.inline(F.arrays_zip(before.alias("before"), F.col("words").alias("word"))))
    return pairs.select(
        *keys,
        F.xxhash64("before", "word").alias("a"),
        F.xxhash64(F.lit("b"), "before", "word").alias("b"),
        F.coalesce(F.char_length("word"), F.lit(0)).cast("long").alias("weight"),
    )


def simhash(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys, a, b``: one row per key with the fingerprint of its text as two longs."""
    lanes = [
        F.sum(F.shiftrightunsigned(h, i).bitwiseAND(F.lit(_LANES)) * F.col("weight")).alias(f"{h}{i}") for h in ("a", "b") for i in range(32)
    ]
    counted = terms(rows, keys, text).groupBy(*keys).agg(*lanes, F.sum("weight").alias("all"))

    def bits(h: str) -> Column:
        out = F.lit(0).cast("long")
        for i in range(32):
            lane = F.col(f"{h}{i}")
            for at, ones in ((i, lane.bitwiseAND(F.lit(0xFFFFFFFF))), (i + 32, F.shiftrightunsigned(lane, 32))):
                won = F.when(ones * 2 > F.col("all"), F.lit(1)).otherwise(F.lit(0)).cast("long")
                out = out.bitwiseOR(F.shiftleft(won, at))
        return out

    return counted.select(*keys, bits("a").alias("a"), bits("b").alias("b"))


def distance(a: Column, b: Column, other_a: Column, other_b: Column) -> Column:
    """Hamming distance of two fingerprints."""
    return F.bit_count(a.bitwiseXOR(other_a)) + F.bit_count(b.bitwiseXOR(other_b))


def likeness(bits: Column) -> Column:
    """The cosine of the angle at which the share of differing bits is expected, at least 0."""
    return F.greatest(F.lit(0.0), F.cos(bits * F.pi() / F.lit(BITS)))


def hexadecimal(a: Column, b: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0")))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``key, doc_id, digest, text``: one key of 32 bytes for an id and a text."""
    i = F.col(id_col)
    rows = docs.select(i.alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("digest", exact_digest(F.col("text")))
    name = F.when(F.col("doc_id").isNull(), F.lit("null")).otherwise(F.concat(F.lit("id "), F.col("doc_id").cast("string")))
    return rows.withColumn("key", F.unhex(F.sha2(F.concat_ws(":", name, "digest").cast("binary"), 256)))


def followers(keyed: DataFrame) -> tuple[DataFrame, bool]:
    """Staged ``key, doc_id, n, copies, next_key``, one row per id and text, and whether any is
    repeated. Rows are sorted in ranges and numbered within each; the ranges' sizes (one row each)
    turn that into positions, and a row's next one has the position after it."""
    one = keyed.groupBy("key", "doc_id", "digest", F.char_length("text").cast("long").alias("n")).agg(F.count(F.lit(1)).alias("copies"))
    sort = one.orderBy(F.col("doc_id").desc_nulls_last(), "digest").withColumn("at", F.monotonically_increasing_id())
    ordered, _ = stage(sort.select("key", "doc_id", "n", "copies", "at"), "order")
    part, within = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = ordered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("size"))
    before = sizes.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("before"))
    rows = ordered.withColumn("part", part).join(F.broadcast(before), "part").withColumn("position", F.col("before") + within)
    total = ordered.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.max("copies"), F.lit(0)).alias("copies")).first()
    after = rows.select(F.pmod(F.col("position") - 1, F.lit(max(1, total["rows"]))).alias("position"), F.col("key").alias("next_key"))
    linked, _ = stage(rows.join(after, "position").select("key", "doc_id", "n", "copies", "next_key"), "followers")
    return linked, total["copies"] > 1


def prints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Staged ``doc_id, n_chars, copies, edited_sha256, a, b, edited_a, edited_b, next_a, next_b``,
    one row per id and text. The edited text ends with the beginning of the next document instead
    of the last ``n_chars // 2`` characters. Whole texts are shuffled once, the parts that change
    documents a second time."""
    keyed = _keyed(docs, id_col, text_col)
    linked, repeated = followers(keyed)
    texts = keyed.select("key", "text")
    if repeated:
        texts = texts.dropDuplicates(["key"])
    half = F.expr("n div 2")
    sent = linked.select(F.col("next_key").alias("key"), F.col("key").alias("receiver"), half.cast("int").alias("wanted"))
    moved = texts.join(sent.hint("merge"), "key").select(
        F.col("receiver").alias("key"), F.substring("text", F.lit(1), F.col("wanted")).alias("ending")
    )
    kept = linked.select("key", (F.col("n") - half).cast("int").alias("kept"))
    edited = (
        texts.join(kept.hint("merge"), "key")
        .join(moved.hint("merge"), "key")
        .select("key", "text", F.concat(F.substring("text", F.lit(1), F.col("kept")), "ending").alias("edited"))
    )
    versions = F.array(*[F.struct(F.lit(i).alias("version"), F.col(c).alias("text")) for i, c in enumerate(("text", "edited"))])
    both = edited.select("key", F.unhex(exact_digest(F.col("edited"))).alias("digest"), F.inline(versions))
    voted = simhash(both, ["key", "digest", "version"], "text")
    own, other = F.col("version") == 0, F.col("version") == 1
    found, _ = stage(
        voted.groupBy("key", "digest").agg(
            F.max(F.when(own, F.col("a"))).alias("a"),
            F.max(F.when(own, F.col("b"))).alias("b"),
            F.max(F.when(other, F.col("a"))).alias("edited_a"),
            F.max(F.when(other, F.col("b"))).alias("edited_b"),
        ),
        "prints",
    )
    theirs = found.select(F.col("key").alias("next_key"), F.col("a").alias("next_a"), F.col("b").alias("next_b"))
    rows, _ = stage(
        linked.join(found, "key")
        .join(theirs, "next_key")
        .select(
            "doc_id", F.col("n").alias("n_chars"), "copies", F.lower(F.hex("digest")).alias("edited_sha256"),
            "a", "b", "edited_a", "edited_b", "next_a", "next_b",
        ),
        "fingerprints",
    )
    return rows


class BlockTables:
    """Choices of ``kept`` of ``radius + kept`` blocks of the bits, each with its masks for both
    longs and the masks of earlier blocks outside it, on which a pair first met there differs."""

    def __init__(self, radius: int, kept: int):
        blocks = radius + kept
        cuts = [BITS * i // blocks for i in range(blocks + 1)]
        masks = [self._signed(((1 << high) - 1) ^ ((1 << low) - 1)) for low, high in zip(cuts, cuts[1:], strict=False)]
        self.tables = []
        for chosen in combinations(range(blocks), kept):
            a, b = (sum(masks[i][side] for i in chosen) for side in (0, 1))
            self.tables.append(((a, b), [masks[i] for i in range(chosen[-1]) if i not in chosen]))

    @staticmethod
    def _signed(mask: int) -> tuple[int, int]:
        """The mask's upper and lower 64 bits as longs. Masks of blocks are disjoint, so those of
        several blocks add up."""
        return tuple(v - (1 << 64) if v >> 63 else v for v in (mask >> 64, mask & ((1 << 64) - 1)))

    @classmethod
    def for_sizes(cls, rows: int, queries: int, radius: int) -> BlockTables:
        """The choice with the least entries written and pairs compared."""

        def cost(kept: int) -> float:
            return comb(radius + kept, kept) * (rows + queries + rows * queries / 2.0 ** (BITS * kept / (radius + kept)))

        return cls(radius, min(range(1, 5), key=cost))

    def keys(self, rows: DataFrame, *columns: str, with_earlier: bool = False) -> DataFrame:
        """Every row in every table: ``columns, a, b, table, key_a, key_b`` and ``earlier``."""
        entries = []
        for t, ((a, b), earlier) in enumerate(self.tables):
            fields = [F.lit(t).alias("table"), F.col("a").bitwiseAND(F.lit(a)).alias("key_a"), F.col("b").bitwiseAND(F.lit(b)).alias("key_b")]
            if with_earlier:
                listed = F.array(*[F.struct(F.lit(x).cast("long").alias("a"), F.lit(y).cast("long").alias("b")) for x, y in earlier])
                fields.append(listed.cast("array<struct<a:bigint,b:bigint>>").alias("earlier"))
            entries.append(F.struct(*fields))
        return rows.select(*columns, "a", "b", F.inline(F.array(*entries)))


def within_radius(rows: DataFrame, queries: DataFrame, radius: int = RADIUS, cell: int = CELL) -> DataFrame:
    """``a, b, asked, near``: for every distinct fingerprint of ``queries`` how many queries have it
    and the number of ``rows`` whose fingerprint is within the radius, its own included if it is
    among them."""
    entries, _ = stage(rows.groupBy("a", "b").agg(F.count(F.lit(1)).alias("docs")), "entries")
    asked, _ = stage(queries.groupBy("a", "b").agg(F.count(F.lit(1)).alias("asked")), "asked")
    tables = BlockTables.for_sizes(entries.count(), asked.count(), radius)
    on = ["table", "key_a", "key_b"]
    listed = tables.keys(entries, "docs")
    counts = listed.groupBy(*on).agg(F.count(F.lit(1)).alias("entries")).where(F.col("entries") > cell)
    large, _ = stage(counts.select(*on, F.ceil(F.col("entries") / cell).cast("int").alias("cells")), "large-keys")
    cells = F.coalesce("cells", F.lit(1))
    held = (
        listed.join(large, on, "left")
        .withColumn("cell", F.pmod(F.xxhash64("a", "b"), cells).cast("int"))
        .groupBy(*on, "cell")
        .agg(F.collect_list(F.struct("a", "b", "docs")).alias("held"))
    )
    wanted = (
        tables.keys(asked, "asked", with_earlier=True)
        .join(large, on, "left")
        .withColumn("cell", F.explode(F.sequence(F.lit(0), cells - 1)))
        .drop("cells")
    )

    def meets(entry: Column) -> Column:
        near = distance(F.col("a"), F.col("b"), entry["a"], entry["b"]) <= radius
        a, b = F.col("a").bitwiseXOR(entry["a"]), F.col("b").bitwiseXOR(entry["b"])
        here = F.forall("earlier", lambda m: a.bitwiseAND(m["a"]).bitwiseOR(b.bitwiseAND(m["b"])) != 0)
        return near & here

    met = wanted.join(held, [*on, "cell"]).select(
        "a", "b", "asked", F.aggregate(F.filter("held", meets), F.lit(0).cast("long"), lambda n, e: n + e["docs"]).alias("near")
    )
    return met.groupBy("a", "b", "asked").agg(F.sum("near").alias("near"))


def report(docs: DataFrame, is_query: Column, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row per document: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, n_near``. ``n_near`` counts the other documents within the radius of
    those for which ``is_query``, a condition on ``doc_id``, holds; it is null for the others."""
    found = prints(docs, id_col, text_col)
    single = found.where("copies = 1")
    # copies of a row are written by many tasks, however many there are
    parts = found.where("copies > 1").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {COPIES}"))))
    parts = parts.repartition(F.xxhash64("doc_id", "a", "part"))
    copy = F.sequence(F.lit(1).cast("long"), F.least(F.lit(COPIES).cast("long"), F.col("copies") - F.col("part") * COPIES))
    rows = single.unionByName(parts.withColumn("copy", F.explode(copy)).drop("part", "copy"))
    asked = F.coalesce(is_query, F.lit(False))
    near, _ = stage(within_radius(rows, rows.where(asked), radius), "near")
    # queries with a fingerprint that many share stay where they lie; there are few such prints
    total = near.agg(F.coalesce(F.sum("asked"), F.lit(0))).first()[0]
    common = F.col("asked") * HEAVY_KEYS > total
    prints_of = near.select("a", "b", F.col("near").alias("n"), "asked")
    heavy, light = (prints_of.where(c).drop("asked") for c in (common, ~common))
    queries = rows.where(asked)
    counted = queries.join(F.broadcast(heavy), ["a", "b"]).unionByName(queries.join(light, ["a", "b"]))
    joined = counted.unionByName(rows.where(~asked).withColumn("n", F.lit(None).cast("long")))
    return joined.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        hexadecimal(F.col("a"), F.col("b")).alias("fingerprint"),
        hexadecimal(F.col("edited_a"), F.col("edited_b")).alias("edited_fingerprint"),
        likeness(distance(F.col("a"), F.col("b"), F.col("edited_a"), F.col("edited_b"))).alias("near_edited"),
        likeness(distance(F.col("a"), F.col("b"), F.col("next_a"), F.col("next_b"))).alias("near_next"),
        (F.col("n") - 1).alias("n_near"),
    )
