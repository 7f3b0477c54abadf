"""MinHash near-dedup: banded minima, verified links, components by alternating stars.

1. *Signatures.* A document's shingle set is hashed to 64 bits and ``BANDS * ROWS`` universal hash
   minima are taken. Documents with the same set are one *class*, so exact copies never meet as pairs.
2. *Banding.* Classes that share a band meet in a bucket. A bucket emits a star - each member with
   the bucket's pivot, its class that meets most others - and never its pairs. With 32 bands of 4 rows a pair at similarity 0.8 misses
   every bucket once in 20 million.
3. *Verification.* Stars whose signatures are far below the threshold go; the others are confirmed on
   the full sets of hashed shingles; so is the pair of every bucket of two.
4. *Components* by alternating large-star and small-star.
5. *The rest of the buckets.* Where a bucket still holds several components, a star may have missed a link
   between two members. Their classes are joined once more by an exact prefix join: only the rarest
   shingles of each set are keys, with length and position bounds, so a pair is made only if it can
   still reach the threshold. New links are confirmed and the components brought up to date.

Scale: text is read once for signatures and once more for the classes in stars, in Python workers over
Arrow batches; everything else is slim rows. A passage or a copy that a third of
the corpus shares gives one row per member and band, counted with partial aggregates.

Edge cases: a document without words (null, empty or blank text) has 0 shingles
and is linked with nothing; a null doc_id gets its class's component; rows that repeat a doc_id are separate
members of one class or, with other texts, of several; ``keep_first`` keeps one row of each component, and one with a
null id only where the component has no other; an empty table gives an
empty result. Extra columns are not read. Very long texts are hashed whole, in blocks.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from formbook.llm.common import materialize, same, ship, skew_join

BANDS, ROWS = 32, 4
#: Signatures that agree in fewer places than threshold minus this are not verified (6 standard deviations).
SLACK = 0.22
#: Bits of the filter that texts pass before they are shuffled, a power of two: 4 MB whatever is wanted. Where more is wanted than it can tell apart, more texts pass.
FILTER_BITS = 1 << 25
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; the whole sequence where there are fewer words."""
    import xxhash

    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space alone
    if not tokens:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    n = max(1, len(h) - words + 1)
    if len(h) < words:
        words = len(h)
        mixed = np.full(1, words, np.uint64)  # shorter sequences hash unlike shingles
    else:
        mixed = np.zeros(n, np.uint64)
    for i in range(words):
        mixed = mixed * _MULTIPLIER + h[i : i + n]
        mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def universal(seed: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and offsets of the family h -> a*h + b modulo 2^32, a odd."""
    rng = np.random.default_rng(seed)
    return (rng.integers(0, 2**32, count, dtype=np.uint32) | np.uint32(1))[:, None], rng.integers(0, 2**32, count, dtype=np.uint32)[:, None]


def minima(hashes: np.ndarray, a: np.ndarray, b: np.ndarray, block: int = 512) -> np.ndarray:
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(short), block):
        np.minimum(out, (a * short[i : i + block] + b).min(axis=1), out=out)
    return out


def _signatures(words: int, seed: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        a, b = universal(seed, BANDS * ROWS)
        for batch in batches:
            n, cls, sig = [], [], []
            for text in batch.column(1).to_pylist():
                h = shingle_hashes(text, words)
                n.append(len(h))
                if not len(h):
                    cls.append(None), sig.append(None)
                    continue
                cls.append(xxhash.xxh3_128_digest(h.tobytes()))
                sig.append(minima(h, a, b).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), pa.array(n, pa.int64()), pa.array(cls, pa.binary()), pa.array(sig, pa.binary())], ["doc_id", "text_key", "text_check", "n_shingles", "digest", "sig"])

    return of


def _sets(words: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            classes, sets = [], []
            for cls, want, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                h = shingle_hashes(text, words)
                if xxhash.xxh3_128_digest(h.tobytes()) == want:
                    classes.append(cls), sets.append(h.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(classes, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["class", "set"])

    return of


def _agreement(pairs: DataFrame) -> DataFrame:
    """(a, b, n, agree) of pairs: ``agree`` is in how many places two signatures agree."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = ([np.frombuffer(v, np.uint32) for v in batch.column(i).to_pylist()] for i in (3, 4))
            agree = (np.array(x) == np.array(y)).sum(axis=1) if x else []
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(agree, pa.int64())], ["a", "b", "n", "agree"])

    return pairs.select("a", "b", "n", "sig_a", "sig_b").mapInArrow(of, "a long, b long, n long, agree long")


def bands(sig: Column) -> Column:
    """The keys of a signature's bands."""
    width = 4 * ROWS
    return F.array(*[F.xxhash64(F.substring(sig, 1 + i * width, width), F.lit(i)) for i in range(BANDS)])


def similar(n_a: Column, n_b: Column, both: Column, percent: int) -> Column:
    return 100 * both >= percent * (n_a + n_b - both)


def components(links: DataFrame, most_rounds: int = 50) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b): alternating large-star and small-star.

    A round points each node's larger neighbours (large-star), then itself and its smaller
    neighbours (small-star), at the smallest neighbour. Every round is a table in
    the shared folder; the loop ends when a round changes no link.
    """

    def star(edges: DataFrame, large: bool) -> DataFrame:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        met = both.join(least, "a")
        if large:
            return met.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        out = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        return out.where(F.col("a") != F.col("b")).distinct()

    edges = materialize(links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = lambda e: e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1000003)).first()
    seen = mark(edges)
    for _ in range(most_rounds):
        edges = materialize(star(star(edges, True), False), "stars")
        now = mark(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def key_bits(keys: DataFrame, key: str) -> np.ndarray:
    """A bit for each remainder of ``key`` by ``FILTER_BITS``, as bytes; set where a key has it."""
    place = 1 + F.pmod(F.col(key), F.lit(FILTER_BITS))
    parts = keys.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in parts.collect():  # at most FILTER_BITS / 32768 rows of 4 kB
        raw = np.frombuffer(r.bits, np.uint8)
        out[(r.part - 1) * len(raw) : r.part * len(raw)] = raw
    return out


def _held(bits):
    """Rows whose first column's bit is set."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = bits.value
        for batch in batches:
            at = batch.column(0).to_numpy().view(np.uint64) & np.uint64(FILTER_BITS - 1)
            held = (own[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1
            yield batch.filter(pa.array(held.astype(bool)))

    return of


def text_keys(text: str) -> list[Column]:
    """Two hashes that a text is found again by."""
    return [F.xxhash64(text).alias("text_key"), F.xxhash64(F.lit(1), text).alias("text_check")]


def shingle_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(class, set) of the ``wanted`` classes (class, digest, text_key, text_check): their texts are found again by two hashes and hashed once more."""
    bits = docs.sparkSession.sparkContext.broadcast(key_bits(wanted, "text_key"))
    held = docs.where("text is not null").select(*text_keys("text"), "text").mapInArrow(_held(bits), "text_key long, text_check long, text string")
    # ``wanted`` is a stored table, so adaptive execution splits the copies of one text; one of them leaves each task.
    texts = held.join(wanted, ["text_key", "text_check"]).groupBy("class", "digest").agg(F.first("text").alias("text"))
    return texts.select("class", "digest", "text").mapInArrow(_sets(words), "class long, set array<bigint>")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    left, right = sets.select(F.col("class").alias("a"), F.col("set").alias("set_a")), sets.select(F.col("class").alias("b"), F.col("set").alias("set_b"))
    met = skew_join(pairs.select("a", "b"), left, ["a"], pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n"))).join(right, "b")
    return met.where(similar(F.size("set_a"), F.size("set_b"), F.size(F.array_intersect("set_a", "set_b")), percent)).select("a", "b")


def prefix_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Exact candidates (a, b) among members (class, root, set) of different roots.

    Shingles are ranked from rare to frequent. Two sets can only reach the threshold if the larger
    one's first n - ceil(t n) + 1 shingles meet the smaller one's first n - ceil(2t/(1+t) n) + 1, at
    positions after which enough shingles remain in both.
    """
    t = percent / 100
    share = 2 * t / (1 + t)
    n = F.size("set")
    loose = members.select("class", "root", n.alias("n"), F.explode("set").alias("s"))
    often = loose.groupBy("s").agg(F.count(F.lit(1)).alias("often"), (F.min("root") != F.max("root")).alias("apart")).where("often > 1")
    # A shingle of one set alone meets no other: it only stands before the others in its set's ranks.
    alone = F.col("n") - F.count(F.lit(1)).over(W.partitionBy("class"))
    ranked = loose.join(often, "s").withColumn("rank", alone + F.row_number().over(W.partitionBy("class").orderBy("often", "s")))
    ranked = ranked.where((F.col("rank") <= F.col("n") - F.ceil(F.col("n") * t - 1e-9) + 1) & F.col("apart"))
    # The keys just before, so that a pair is made at its first common key alone.
    before = F.collect_list("s").over(W.partitionBy("class").orderBy("rank").rowsBetween(-16, -1))
    ranked = materialize(ranked.withColumn("before", before).withColumn("short", F.col("rank") <= F.col("n") - F.ceil(F.col("n") * share - 1e-9) + 1).select("s", "class", "root", "n", "rank", "before", "short"), "prefixes")
    x = ranked.where("short").select("s", *[F.col(c).alias(f"x_{c}") for c in ("class", "root", "n", "rank", "before")])
    y = ranked.select("s", *[F.col(c).alias(f"y_{c}") for c in ("class", "root", "n", "rank", "before")])
    needed = F.ceil((F.col("x_n") + F.col("y_n")) * (t / (1 + t)) - 1e-9)
    reach = 1 + F.least(F.col("x_n") - F.col("x_rank"), F.col("y_n") - F.col("y_rank"))
    ordered = (F.col("x_n") < F.col("y_n")) | ((F.col("x_n") == F.col("y_n")) & (F.col("x_class") < F.col("y_class")))
    met = x.join(y, (x["s"] == y["s"]) & ordered & (F.col("x_root") != F.col("y_root")) & (F.col("x_n") >= F.col("y_n") * t - 1e-9) & (reach >= needed) & ~F.arrays_overlap("x_before", "y_before"))
    return met.select(F.col("x_class").alias("a"), F.col("y_class").alias("b")).distinct()


def central_pivots(banded: DataFrame) -> DataFrame:
    """(band, class, pivot, n) of the buckets of more than one class.

    A bucket's pivot is its class that meets most others over all its buckets. So the buckets of a group of near copies
    have few pivots between them, mostly one, and a class has about one star rather than one for each band.
    """
    sizes = banded.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = materialize(banded.join(sizes, "band"), "met")
    weights = met.groupBy("class").agg(F.sum("n").alias("weight"))
    weighed = materialize(met.join(weights, "class"), "weighed")
    pivots = weighed.groupBy("band").agg(F.max(F.struct("weight", (-F.col("class")).alias("minus"))).alias("top")).select("band", (-F.col("top.minus")).alias("pivot"))
    return materialize(weighed.drop("weight").join(pivots, "band"), "buckets")


def rooted_rows(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80, seed: int = 7) -> DataFrame:
    """(doc_id, text_key, n_shingles, root) of every row; rows of one root are one component, and a row without words has none."""
    ship(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    signed = docs.select("doc_id", "text", *text_keys("text"))
    signed = materialize(signed.mapInArrow(_signatures(words, seed), "doc_id long, text_key long, text_check long, n_shingles long, digest binary, sig binary"), "signatures")
    classes = signed.where("digest is not null").groupBy("digest").agg(F.min(F.struct("text_key", "text_check")).alias("text"), F.first("sig").alias("sig"), F.count(F.lit(1)).alias("n"))
    # Below, a class goes by its number: half as long as its hash, and stored here, so it stays when tasks run again.
    classes = materialize(classes.select("digest", "text.text_key", "text.text_check", "sig", "n", F.monotonically_increasing_id().alias("class")), "classes")
    banded = classes.select("class", F.explode(bands(F.col("sig"))).alias("band"))
    buckets = central_pivots(banded)
    stars = buckets.where(F.col("class") != F.col("pivot")).groupBy(F.col("pivot").alias("a"), F.col("class").alias("b")).agg(F.min("n").alias("n"))
    # What is looked at again of the members of buckets with more than one class: their signatures, and their sets, which
    # are verified below, or once more after the stars.
    signs = materialize(buckets.select("class").distinct().join(classes.select("class", "digest", "text_key", "text_check", "sig"), "class"), "wanted-signs")
    wanted = materialize(signs.drop("sig"), "wanted")  # slim, so that Spark measures it without the signatures
    sig = lambda c: signs.select(F.col("class").alias(c), F.col("sig").alias(f"sig_{c}"))
    stars = materialize(stars, "stars")
    # A pivot of very many classes is dealt out.
    agreed = _agreement(skew_join(stars, sig("a"), ["a"], stars.groupBy("a").agg(F.count(F.lit(1)).alias("n"))).join(sig("b"), "b"))
    # The pair of a bucket of two is verified whatever its signatures say: no later step looks at it again.
    agreed = materialize(agreed.where((F.col("agree") >= BANDS * ROWS * (percent / 100 - SLACK)) | (F.col("n") == 2)).select("a", "b"), "stars-agreed")
    sets = materialize(shingle_sets(docs, wanted, words), "sets")
    if (missing := wanted.count() - sets.count()) != 0:
        raise RuntimeError(f"{missing} classes have no set: the documents are not those that were signed")
    links = materialize(confirmed(agreed, sets, percent), "links-star")
    roots = materialize(components(links), "roots")
    # Buckets that still hold several components.
    rooted = buckets.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    mixed = rooted.groupBy("band").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.first("n").alias("n")).where("r0 != r1 and n > 2")
    members = rooted.join(mixed.select("band"), "band", "left_semi").select("class", "root").distinct()
    pairs = materialize(prefix_pairs(members.join(sets, "class"), percent), "pairs")  # read more than once below
    met = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct()  # few classes: only their sets travel
    more = materialize(confirmed(pairs, sets.join(met, "class", "left_semi"), percent), "links-rest")
    if more.head(1):
        roots = materialize(components(reduce(DataFrame.unionByName, [links, more])), "roots")
    rows = signed.select("doc_id", "text_key", "n_shingles", "digest")
    # Roots meet classes, then rows: a class of very many copies is dealt out.
    rooted = classes.select("class", "digest", "n").join(roots.withColumnRenamed("node", "class"), "class", "left").select("digest", "n", F.coalesce("root", "class").alias("root"))
    rooted = materialize(rooted, "class-roots")
    words_in = skew_join(rows.where("digest is not null"), rooted.select("digest", "root"), ["digest"], rooted.select("digest", "n")).select("doc_id", "text_key", "n_shingles", "root")
    none = rows.where("digest is null").select("doc_id", "text_key", "n_shingles", F.lit(None).cast("long").alias("root"))
    return materialize(words_in.unionByName(none), "rooted")


def near_duplicates(docs: DataFrame, **how) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    component_id: smallest doc_id reachable over links of ``percent`` similarity or more; kept: it is its own.
    """
    rows = rooted_rows(docs, **how).drop("text_key")
    least = materialize(rows.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("n")), "least")
    met = skew_join(rows.where("root is not null"), least.drop("n"), ["root"], least.select("root", "n"))
    out = met.select("doc_id", "n_shingles", "component_id", same(F.col("doc_id"), F.col("component_id")).alias("kept"))
    none = rows.where("root is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    return out.unionByName(none)


def keep_first(docs: DataFrame, **how) -> DataFrame:
    """One row of every component of ``docs``, that of the smallest doc_id; null ids come last. Rows without words stay.

    A row is known by its doc_id and the hash of its text, so that texts that share a doc_id are told apart; of
    rows that repeat both, one stays.
    """
    keys = rooted_rows(docs, **how).where("root is not null").groupBy("root", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("n"))
    keys = materialize(keys, "keys")
    first = keys.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_key", "n")).alias("first")).select("first.*")
    first = materialize(first.select("doc_id", "text_key", "n"), "first")

    own = uuid.uuid4().hex  # names that no table has
    key, doc_key, text_key = f"key_{own}", f"doc_{own}", f"text_{own}"

    def named(rows: DataFrame) -> DataFrame:
        return rows.select(F.col("doc_id").alias(doc_key), F.col("text_key").alias(text_key))

    def met(left: DataFrame, rows: DataFrame, how: str) -> DataFrame:
        return left.join(named(rows), same(F.col(id_col), F.col(doc_key)) & (F.col(key) == F.col(text_key)), how)

    id_col, text_col = how.get("id_col", "doc_id"), how.get("text_col", "text")
    gone = keys.join(named(first), same(F.col("doc_id"), F.col(doc_key)) & (F.col("text_key") == F.col(text_key)), "left_anti")
    out = met(docs.withColumn(key, F.xxhash64(text_col)), gone, "left_anti")
    again = first.where("n > 1")
    if again.head(1):
        out = met(out, again, "left_anti").unionByName(met(out, again, "left_semi").dropDuplicates([id_col, key]))
    return out.drop(key)
