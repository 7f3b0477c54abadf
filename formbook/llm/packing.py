"""Packing by non-negative least squares.

Documents become token ids, cut into whole windows and one rest each. Whole
windows are sequences of their own. For the rests, lengths are put into bins
(rounded up, so that a plan by bins always fits); shallow combinations of bins
that fill a window exactly are enumerated, and non-negative least squares
against the histogram says how often to use each. Counts are rounded down,
and what stays of the histogram is packed greedily, largest bin first.

Scale: text is tokenised once, and the rests' pieces (id, start, length, checksum) are all
that is shuffled; a piece that fills its window by itself needs no plan and gets its sequence in place. The driver sees the histogram, one count for each bin, and
makes a plan whose size is bounded by the bins: a slot takes an interval of ranks
of its bin. A piece's rank is a running number inside (bin, range of a hash) plus the
totals of the ranges before, so no bin is gathered in one task; each sequence is then
laid out on its own.

Edge cases: a null or empty text is its end token alone; a null doc_id is kept;
repeated rows are separate documents with the same pieces; an empty table gives
an empty result; extra columns are not read; very long texts are cut into as
many windows as they need.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from formbook.llm.common import materialize, ship

WINDOW, END_ID, GRAIN, DEPTH = 2048, 1, 16, 3
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
#: Parts of words whose ids a Python worker keeps in each of two generations: they bound its memory alone; others are encoded again.
CACHED_PARTS = 200_000
#: Bytes of text that a task takes at once; a longer text is taken alone.
CHUNK = 8_000_000


class WordEncoder:
    """Ids of texts by a tokenizer that drops white space, so that a text's ids are its words' ids in a row.

    Arrow lower-cases, splits and numbers the words of a chunk; only its distinct parts are looked up. A plain
    word (letters, then punctuation) has two parts, any other word is one. Parts of letters that were not met before are
    encoded together: each ends with exactly one id whose token closes a word, which tells the joint encoding apart again.
    With ``special`` the literal text of an added token is that token, as in the tokenizer's plain call: it holds no white
    space, so it is inside one word, and such a word is encoded by itself. Without, it is text like any other.
    A tokenizer of another kind (one that keeps white space or case) encodes whole texts.
    """

    def __init__(self, path: str, special: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.kind = np.uint16 if max(vocab.values()) < 1 << 16 else np.uint32
        self.closes = np.zeros(max(vocab.values()) + 1, bool)
        self.closes[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.parts: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        # Latin letters below U+0250 in lower case but for U+0130, whose lower case is two characters; tails without an apostrophe.
        self.letters = "".join(c for c in map(chr, range(0x61, 0x250)) if c.isalpha() and c != "\u0130")
        self.signs = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
        one = lambda t: self.tokenizer.encode(t, add_special_tokens=False).ids
        joint = [one("qzx"), one(","), one("vé")]
        self.by_words = one(" Qzx,\n\tVé ") == sum(joint, []) and all(self.closes[x].sum() == 1 and self.closes[x[-1]] for x in joint)

    def _learn(self, parts: list[str]) -> None:
        """Fill ``parts``: runs of plain lower-case letters in one go, the rest one by one."""
        letters, rest = [], []
        for p in parts:
            (letters if p.isalpha() else rest).append(p)
        for i in range(0, len(letters), 150):
            some = letters[i : i + 150]
            ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, self.kind)
            ends = (np.flatnonzero(self.closes[ids]) + 1) * ids.itemsize
            if len(ends) != len(some):
                rest += some
                continue
            raw, begin = ids.tobytes(), 0
            for p, end in zip(some, ends.tolist(), strict=True):
                self.parts[p] = raw[begin:end]
                begin = end
        for i in range(0, len(rest), 1000):
            some = rest[i : i + 1000]
            for p, e in zip(some, self.tokenizer.encode_batch(some, add_special_tokens=False), strict=True):
                self.parts[p] = np.array(e.ids, self.kind).tobytes()

    def _ids(self, parts: list[str]) -> list[bytes]:
        if len(self.parts) > CACHED_PARTS:
            self.parts, self.older = {}, self.parts
        known, older = self.parts, self.older
        new = []
        for p in parts:
            if p not in known:
                if p in older:
                    known[p] = older[p]
                else:
                    new.append(p)
        self._learn(new)
        return [known[p] for p in parts]

    def _whole(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = [np.array(e.ids, self.kind) for e in self.tokenizer.encode_batch(texts.to_pylist(), add_special_tokens=False)]
        return np.concatenate(found) if found else np.empty(0, self.kind), np.array([len(x) for x in found], np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (no nulls) in a row, and how many each has."""
        if not self.by_words:
            return self._whole(texts)
        low = pc.ascii_lower(texts)
        for t in self.added:  # lower case would make an added token of what is none
            if pc.any(holds := pc.match_substring(low, t.lower())).as_py():
                low = pc.if_else(holds, texts, low)
        lists = pc.ascii_split_whitespace(low)
        coded = lists.flatten().dictionary_encode()
        words, at = coded.dictionary, coded.indices.to_numpy()
        tails = pc.utf8_ltrim(words, self.letters)
        plain = pc.equal(pc.ascii_ltrim(tails, self.signs), "")
        heads = pc.if_else(plain, pc.ascii_rtrim(words, self.signs), words)
        parts = pa.concat_arrays([heads, pc.if_else(plain, tails, "")]).dictionary_encode()
        ids = self._ids(parts.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // np.dtype(self.kind).itemsize
        begins = np.cumsum(sizes) - sizes
        table = np.frombuffer(b"".join(ids), self.kind)
        which = parts.indices.to_numpy()
        order = np.empty(2 * len(at), np.int64)  # head and tail of every word
        order[0::2], order[1::2] = which[: len(words)][at], which[len(words) :][at]
        many = sizes[order]
        ends = np.cumsum(many)
        total = int(ends[-1]) if len(ends) else 0
        flat = table[np.repeat(begins[order] - (ends - many), many) + np.arange(total)] if total else np.empty(0, self.kind)
        edges = np.concatenate([[0], ends])[2 * lists.offsets.to_numpy()]
        return flat, np.diff(edges)


_ENCODERS: dict[tuple[str, bool], WordEncoder] = {}


def _chunks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + CHUNK, "right")))
        yield batch.slice(at, end - at)
        at = end


def _pieces(tokenizer: str, window: int, end_id: int, special: bool):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        encoder = _ENCODERS.get((tokenizer, special)) or _ENCODERS.setdefault((tokenizer, special), WordEncoder(tokenizer, special))
        for batch in (c for b in batches for c in _chunks(b)):
            flat, sizes = encoder.encode(pc.fill_null(batch.column(1), "").cast(pa.string()))
            full = sizes + 1
            ids = np.full(int(full.sum()), end_id, "<u4")
            inside = np.ones(len(ids), bool)
            inside[np.cumsum(full) - 1] = False
            ids[inside] = flat
            counts = -(-full // window)
            doc = np.repeat(np.arange(len(full)), counts)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)) * window
            length = np.minimum(window, full[doc] - start)
            begin = (np.cumsum(full) - full)[doc] + start
            raw = memoryview(ids).cast("B")
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begin.tolist(), (begin + length).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc)), *[pa.array(c, pa.int64()) for c in (start, length, crc, full[doc])]], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
        encoder.older = {}

    return of


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """Least squares with x >= 0 by accelerated projected gradients; a is small and dense."""
    gram, target = a.T @ a, a.T @ b
    step = 1.0 / max(np.linalg.norm(gram, 2), 1e-12)
    x = y = np.zeros(a.shape[1])
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(y - step * (gram @ y - target), 0.0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        if (y - new) @ (new - x) > 0:
            t_new, y = 1.0, new
        else:
            y = new + (t - 1) / t_new * (new - x)
        if np.abs(new - x).max(initial=0) <= 1e-7 * (1 + np.abs(x).max(initial=0)):
            x = new
            break
        x, t = new, t_new
    return x


def combinations(bins: int, depth: int) -> list[tuple[int, ...]]:
    """All ways to fill a window of ``bins`` grains with 2 to ``depth`` bins."""
    found = []
    for d in range(2, depth + 1):
        for c in combinations_with_replacement(range(1, bins), d - 1):
            if (last := bins - sum(c)) >= c[-1]:
                found.append((*c, last))
    return found


def plan(histogram: dict[int, int], bins: int, depth: int) -> list[tuple[tuple[int, ...], int]]:
    """(combination of bins, how often): every piece of the histogram is in exactly one."""
    left = np.zeros(bins + 1, np.int64)
    for b, n in histogram.items():
        left[b] = n
    chosen: list[tuple[tuple[int, ...], int]] = [((bins,), int(left[bins]))] if left[bins] else []
    left[bins] = 0
    shapes = combinations(bins, depth)
    if shapes and left.any():
        a = np.zeros((bins, len(shapes)))
        for j, c in enumerate(shapes):
            for b in c:
                a[b, j] += 1
        x = nnls(a, left[:bins].astype(float))
        for j in np.argsort(-x, kind="stable"):
            times = min([int(x[j]), *(int(left[b]) // shapes[j].count(b) for b in set(shapes[j]))])
            if times > 0:
                chosen.append((shapes[j], times))
                for b in shapes[j]:
                    left[b] -= times
    # Residuals: the largest bin that is left, filled up with the largest that still fit.
    while left.any():
        free, shape, taken = bins, [], np.zeros_like(left)
        while free and (fits := np.flatnonzero(left[: free + 1] - taken[: free + 1] > 0)).size:
            b = int(fits[-1])
            many = int(min(free // b, left[b] - taken[b]))
            shape += [b] * many
            taken[b] += many
            free -= b * many
        used = np.flatnonzero(taken)
        times = int((left[used] // taken[used]).min())
        chosen.append((tuple(shape), times))
        left -= taken * times
    return chosen


def pack(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end_id: int = END_ID, grain: int = GRAIN, depth: int = DEPTH, special: bool = False) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``special``: the literal text of an added token, like <|endoftext|>, gets that token's id.
    """
    spark = docs.sparkSession
    ship(spark)
    bins = window // grain
    pieces = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_pieces(tokenizer, window, end_id, special), PIECES)
    order = F.xxhash64("doc_id", "start", "length", "ids_crc32")
    pieces = pieces.withColumn("order", order).withColumn("bin", F.ceil(F.col("length") / grain).cast("int")).withColumn("range", F.shiftrightunsigned("order", 54).cast("int"))
    pieces = materialize(pieces, "pieces")
    ranges = pieces.groupBy("bin", "range").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r.bin: r.n for r in ranges.groupBy("bin").agg(F.sum("n").alias("n")).collect()}  # at most ``bins`` rows
    slots, first = [], 0
    used = dict.fromkeys(range(bins + 1), 0)
    for shape, times in plan(histogram, bins, depth):
        if shape == (bins,):
            continue  # a piece that fills a window is a sequence by itself
        at = 0
        for b in dict.fromkeys(shape):
            many = shape.count(b)
            slots.append((b, used[b], used[b] + many * times, many, at, first))
            used[b] += many * times
            at += many
        first += times
    alone = pieces.where(F.col("bin") >= bins).withColumn("sequence_id", F.lit(first) + F.monotonically_increasing_id())
    alone = alone.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", F.lit(0).cast("long").alias("offset"))
    slots = spark.createDataFrame(slots, "s_bin int, low long, high long, many int, at int, first long")  # bounded by the number of bins
    before = F.coalesce(F.sum("n").over(W.partitionBy("bin").orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before")
    ranked = pieces.where(F.col("bin") < bins).join(ranges.select("bin", "range", before), ["bin", "range"])
    ranked = ranked.withColumn("rank", F.col("before") + F.row_number().over(W.partitionBy("bin", "range").orderBy("order", "doc_id", "start")) - 1)
    placed = ranked.join(F.broadcast(slots), (F.col("bin") == F.col("s_bin")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    inside = F.col("rank") - F.col("low")
    placed = placed.withColumn("sequence_id", F.col("first") + F.floor(inside / F.col("many"))).withColumn("slot", F.col("at") + inside % F.col("many"))
    ahead = F.sum("length").over(W.partitionBy("sequence_id").orderBy("slot").rowsBetween(W.unboundedPreceding, -1))
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", F.coalesce(ahead, F.lit(0)).alias("offset")).unionByName(alone)
