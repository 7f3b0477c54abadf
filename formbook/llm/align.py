"""Cross-tokenizer alignment: which tokens of two vocabularies end together, and how often over the corpus.

A text is encoded by both tokenizers; byte offsets where a token of each ends cut it into groups, and the two
tokens that end there are a link. The first pass counts, in every task, the distinct id pairs that it links. Over the distinct pairs of all
tasks a minimal perfect hash is built; each task's counts become a dense vector indexed by that hash,
and vectors are added up a tree of tasks. Keys are stored beside the counts, so a look-up is verified. The second pass aligns
the documents again and looks the counts up.

Both tokenizers are cut at a single space between two characters that are not white space: the first never
joins what stands before such a space with it (its split pattern starts a new part there), and no piece of the second has a space behind
another character (checked when it is loaded). So a text is a row of words, each aligned once
and kept; a word's groups never reach over its end.

Scale: two linked tokens end together in one text, so the bytes of one are a suffix of the other's. Hence the two
vocabularies alone bound how many distinct pairs there can be (``most_pairs``, some hundred thousand), whatever the corpus: this
is checked, and is what lets the table of pairs meet at the driver and be broadcast. A task sends one row of at most that many keys;
vectors are summed in slices, ``FAN`` tasks at a time, so no task adds up the whole corpus. Documents are never shuffled.

Edge cases: a null or empty text, and one whose tokens do not give back its bytes (a literal U+2581), has no tokens: zeros and
an empty digest; a null doc_id is kept; repeated rows count each for themselves; an empty table gives an empty
result; extra columns are not read; very long texts are whole, and a word of more than ``LONG`` characters is aligned each time
it occurs and not kept.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formbook.llm.common import chunks, materialize, ship

#: Words that a Python worker keeps (memory alone; others are aligned again), longest word that is kept.
KEPT_WORDS, LONG = 600_000, 64
#: Vectors that a task adds up, slots of a slice.
FAN, SLICE = 32, 1 << 16
#: A space where both tokenizers start anew. More characters count as white space than any of the tokenizers holds: that cuts less, never wrongly.
_WIDE = r"\s\x1c-\x1f\u0085\u180e\u200b\u2060\ufeff"
_SPACE = re.compile(rf"(?<=[^{_WIDE}]) (?=[^{_WIDE}])")
_EDGE = re.compile(rf"[{_WIDE}]|.*[{_WIDE}]\Z", re.S)
REPORT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_SHIFT, _MISSING = 32, 1 << 40
#: The same for Arrow's patterns: a text with a space at either end or beside what counts as white space above.
_BESIDE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}\x{205f}\x{2060}\x{3000}\x{feff}]"
_ODD = rf"^ | $|{_BESIDE} | {_BESIDE}"


def byte_letters() -> dict[str, int]:
    """The letter that a byte-level vocabulary writes for each byte: printable Latin-1 itself, the others from U+0100 on in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def piece_bytes(piece: str) -> bytes:
    if m := re.fullmatch(r"<0x([0-9A-Fa-f]{2})>", piece):
        return bytes([int(m[1], 16)])
    return piece.replace("▁", " ").encode("utf-8", "surrogatepass")


class Pair:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(path_a, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters = byte_letters()
        ranks = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items()}
        # The vocabulary's merges come in the order of the ids that they make, so ids are ranks; this encoder takes a third of the time.
        made = [model["vocab"][m if isinstance(m, str) and " " not in m else "".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if made != sorted(made):
            raise ValueError("the merges are not in the order of the ids that they make")
        self.a = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes_a[i] = token
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece holds a space behind another character: texts cannot be cut at spaces")
        self.bytes_b = [piece_bytes(p) for p in pieces]
        self.sizes_a, self.sizes_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, bool]:
        """Ids of both tokenizers for a space and ``text``, and whether both give back its bytes."""
        whole = " " + text
        a, b = self.a.encode_ordinary(whole), self.b.encode(text)
        raw = whole.encode("utf-8", "surrogatepass")
        fine = raw == b"".join(map(self.bytes_a.__getitem__, a)) == b"".join(map(self.bytes_b.__getitem__, b))
        return np.array(a, np.int32), np.array(b, np.int32), fine


def most_pairs(bytes_a: list[bytes], bytes_b: list[bytes]) -> int:
    """How many id pairs have bytes of which one is a suffix of the other: no text can link more."""
    count_a, count_b = Counter(x for x in bytes_a if x), Counter(x for x in bytes_b if x)
    total = sum(n * count_b.get(x[i:], 0) for x, n in count_a.items() for i in range(len(x)))
    return total + sum(n * count_a.get(x[i:], 0) for x, n in count_b.items() for i in range(1, len(x)))


def split_words(text: str) -> list[str]:
    """``text`` cut at each space where both tokenizers start anew; that space goes before the next word, as one goes before the text."""
    return _SPACE.split(text)


class PerfectHash:
    """Numbers 0..n-1 for n distinct keys, by levels: keys that are alone in a slot of a level stay there, the others go on."""

    GAMMA = 2.0

    def __init__(self, keys: np.ndarray):
        self.levels: list[np.ndarray] = []
        rest, used = np.unique(keys.astype(np.uint64)), 0
        self.n = len(rest)
        while len(rest):
            slot = self._slot(rest, len(self.levels), int(self.GAMMA * len(rest)) + 1)
            alone = np.bincount(slot, minlength=int(self.GAMMA * len(rest)) + 1) == 1
            number = np.where(alone, used + np.cumsum(alone) - 1, -1).astype(np.int32)
            used += int(alone.sum())
            self.levels.append(number)
            rest = rest[~alone[slot]]
        self.keys = np.empty(self.n, np.int64)
        if self.n:
            self.keys[self._find(keys.astype(np.uint64))] = keys

    @staticmethod
    def _slot(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        x = keys + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & (1 << 64) - 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        out, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, number in enumerate(self.levels):
            if not len(open_):
                break
            got = number[self._slot(keys[open_], level, len(number))]
            out[open_[got >= 0]] = got[got >= 0]
            open_ = open_[got < 0]
        return out

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of ``keys``; -1 where a key is not one of those that the hash was built over."""
        at = self._find(keys.astype(np.uint64))
        if self.n:
            at[self.keys[at] != keys] = -1
        return at


@dataclass
class Block:
    """Words that were aligned together: ids in a row, and for each group its word and where its tokens end."""

    a: np.ndarray
    b: np.ndarray
    end_a: np.ndarray
    end_b: np.ndarray
    groups: np.ndarray  # of each word
    wrong: np.ndarray  # words whose tokens do not give back their bytes

    @property
    def keys(self) -> np.ndarray:
        """The id pair that each group links."""
        return self.a[self.end_a - 1].astype(np.int64) << _SHIFT | self.b[self.end_b - 1]

    def tokens(self, ends: np.ndarray) -> np.ndarray:
        """Of each word."""
        upto = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(self.groups)])]
        return np.diff(upto)

    def shown(self) -> pa.Array:
        """``a1,a2|b1;a3|b2,b3`` of each word."""
        lists = [pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids).cast(pa.string())), ",") for ids, ends in ((self.a, self.end_a), (self.b, self.end_b))]
        groups = pc.binary_join_element_wise(*lists, "|")
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(self.groups)]), pa.int32()), groups), ";")


def align(pair: Pair, words: list[str]) -> Block:
    """Align words, those with white space at an end last. The others go in one go: joined by spaces they are encoded as each by itself."""
    wrong = np.zeros(len(words), bool)
    many = next((i for i, w in enumerate(words) if _EDGE.match(w)), len(words))
    coded = [pair.encode(t) for t in ([" ".join(words[:many])] if many else []) + words[many:]]
    if not all(x[2] for x in coded):
        single = [pair.encode(w) for w in words]
        wrong[:] = [not x[2] for x in single]
        coded = [x for x in single if x[2]]
    a, b = (np.concatenate([x[k] for x in coded]) if coded else np.empty(0, np.int32) for k in (0, 1))
    both, at_a, at_b = np.intersect1d(np.cumsum(pair.sizes_a[a]), np.cumsum(pair.sizes_b[b]), assume_unique=True, return_indices=True)
    sizes = np.array([0 if x else len(w.encode("utf-8", "surrogatepass")) + 1 for w, x in zip(words, wrong, strict=True)], np.int64)
    upto = np.searchsorted(both, np.cumsum(sizes), "right")
    return Block(a, b, at_a + 1, at_b + 1, np.diff(np.concatenate([[0], upto])), wrong)


class Words:
    """Aligned words by number, in blocks; a Python worker keeps them from task to task until there are ``KEPT_WORDS``."""

    def __init__(self, pair: Pair):
        self.pair = pair
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.blocks: list[Block] = []
        self.n = self.tokens = 0

    @property
    def full(self) -> bool:
        return self.n > KEPT_WORDS or self.tokens > 8 * KEPT_WORDS

    def numbers(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all words of ``texts`` (no nulls) in a row, and how many words each text has; an empty text has none."""
        odd = pc.match_substring_regex(texts, _ODD)
        lists = pc.split_pattern(texts, " ")
        if pc.any(odd).as_py():
            lists = pa.array([split_words(t.as_py()) if x else w.as_py() for t, w, x in zip(texts, lists, odd.to_pylist(), strict=True)], pa.list_(pa.string()))
        empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
        many = np.where(empty, 0, pc.list_value_length(lists).to_numpy())
        coded = pc.filter(lists, pa.array(~empty)).flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        new = sorted((w for w in distinct if w not in self.number), key=lambda w: _EDGE.match(w) is not None)
        for at in range(0, len(new), 4000):
            some = new[at : at + 4000]
            block = align(self.pair, some)
            self.blocks.append(block)
            self.number.update(zip(some, range(self.n, self.n + len(some)), strict=True))
            self.n += len(some)
            self.tokens += len(block.a)
        table = np.fromiter(map(self.number.__getitem__, distinct), np.int64, len(distinct))
        for w in new:
            if len(w) > LONG:
                del self.number[w]
        return table[coded.indices.to_numpy()] if len(distinct) else np.empty(0, np.int64), many


_PAIRS: dict[tuple[str, str], Pair] = {}
_WORDS: dict[tuple[str, str], Words] = {}


def _pair(paths: tuple[str, str]) -> Pair:
    return _PAIRS.get(paths) or _PAIRS.setdefault(paths, Pair(*paths))


def _words(paths: tuple[str, str]) -> Words:
    return _WORDS.get(paths) or _WORDS.setdefault(paths, Words(_pair(paths)))


def _per_text(values: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Sums of consecutive ``values``, ``many`` for each text."""
    upto = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(many)
    return upto[ends] - upto[ends - many]


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not keys:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    found, at = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(found), np.int64)
    np.add.at(total, at, np.concatenate(counts))
    return found, total


def _counted(paths: tuple[str, str]):
    """One row for each task: the id pairs that its documents link, and how often."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, uses = _words(paths), np.zeros(0, np.int64)
        keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)

        def flushed():
            each = np.repeat(uses, np.concatenate([b.groups for b in words.blocks])) if words.blocks else uses
            links = np.concatenate([b.keys for b in words.blocks]) if words.blocks else keys
            return _merged([keys, links[each > 0]], [counts, each[each > 0]])

        for batch in (c for b in batches for c in chunks(b, 0)):
            at, many = words.numbers(pc.fill_null(batch.column(0), "").cast(pa.string()))
            wrong = np.concatenate([b.wrong for b in words.blocks]) if words.blocks else np.zeros(0, bool)
            fine = np.repeat(_per_text(wrong[at], many) == 0, many)
            new = np.bincount(at[fine], minlength=words.n)
            new[: len(uses)] += uses
            uses = new
            if words.full:
                keys, counts = flushed()
                words.forget()
                uses = np.zeros(0, np.int64)
        uses = np.concatenate([uses, np.zeros(words.n - len(uses), np.int64)])
        keys, counts = flushed()
        yield pa.RecordBatch.from_arrays([pa.array([keys], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int64()))], ["keys", "counts"])

    return of


def _dense(table):
    """A task's counts as slices of the vector that the hash indexes."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hash_: PerfectHash = table.value
        for batch in batches:
            for node, keys, counts in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                vector = np.zeros(hash_.n, np.int64)
                at = hash_.find(keys.values.to_numpy())
                if (at < 0).any():
                    raise ValueError("an id pair is not among the distinct ones")
                vector[at] = counts.values.to_numpy()
                parts = [vector[i : i + SLICE].tobytes() for i in range(0, hash_.n, SLICE)]
                yield pa.RecordBatch.from_arrays([pa.array([node] * len(parts), pa.int64()), pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], ["node", "slice", "vector"])

    return of


def _added(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    total = np.frombuffer(rows["vector"].iloc[0], np.int64).copy()
    for raw in rows["vector"].iloc[1:]:
        total += np.frombuffer(raw, np.int64)
    return pd.DataFrame({"node": [int(key[0])], "slice": [int(key[1])], "vector": [total.tobytes()]})


def pair_counts(docs: DataFrame, tokenizer_a: str, tokenizer_b: str, *, text_col: str = "text") -> tuple[PerfectHash, np.ndarray]:
    """The hash over all linked id pairs, and each pair's count by its number: at most ``most_pairs`` of them."""
    spark = docs.sparkSession
    ship(spark)
    paths = (tokenizer_a, tokenizer_b)
    own = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(_counted(paths), "keys array<long>, counts array<long>")
    partial = materialize(own.where(F.size("keys") > 0).select(F.monotonically_increasing_id().alias("node"), "keys", "counts"), "pair-counts")
    pair = _pair(paths)
    bound = most_pairs(pair.bytes_a, pair.bytes_b)
    keys = partial.select(F.explode("keys").alias("key")).distinct().limit(bound + 1).toArrow().column("key").to_numpy()
    if len(keys) > bound:
        raise ValueError(f"more than {bound} id pairs: the tokens' bytes do not give back the texts")
    hash_ = PerfectHash(np.sort(keys))
    counts = np.zeros(hash_.n, np.int64)
    if not hash_.n:
        return hash_, counts
    shape = "node long, slice int, vector binary"
    # Tasks are numbered in a row within their partition only, so nodes are dealt out by rank of a hash range.
    tasks = partial.count()
    vectors = partial.select(F.pmod(F.xxhash64("node"), F.lit(max(1, -(-tasks // FAN)))).alias("node"), "keys", "counts").mapInArrow(_dense(spark.sparkContext.broadcast(hash_)), shape)
    nodes = max(1, -(-tasks // FAN))
    while True:
        vectors = vectors.groupBy("node", "slice").applyInPandas(_added, shape)
        if nodes == 1:
            break
        nodes = -(-nodes // FAN)
        vectors = vectors.withColumn("node", F.pmod("node", F.lit(nodes)).cast("long"))
    for r in vectors.collect():  # slices of one vector of at most ``most_pairs`` numbers
        part = np.frombuffer(r.vector, np.int64)
        counts[r.slice * SLICE : r.slice * SLICE + len(part)] = part
    return hash_, counts


def best_of(hash_: PerfectHash, counts: np.ndarray) -> np.ndarray:
    """Whether a pair's count is the highest of its second id, ties included."""
    if not hash_.n:
        return np.zeros(0, bool)
    second = hash_.keys & ((1 << _SHIFT) - 1)
    most = np.zeros(int(second.max()) + 1, np.int64)
    np.maximum.at(most, second, counts)
    return counts == most[second]


def _reported(paths: tuple[str, str], table):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hash_, counts, best = table.value
        words = _words(paths)
        numbers, shown, done = np.zeros((0, 6), np.int64), [], 0

        for batch in (c for b in batches for c in chunks(b, 1)):
            at, many = words.numbers(pc.fill_null(batch.column(1), "").cast(pa.string()))
            new = [numbers]
            for block in words.blocks[done:]:
                found = hash_.find(block.keys)
                known = found >= 0  # a word that only another task's documents hold may have pairs that are not in the table
                values = [np.where(known, x[found], 0) if hash_.n else np.zeros(len(found)) for x in (best, counts)]
                new.append(np.stack([block.tokens(block.end_a), block.tokens(block.end_b), block.groups, *[_per_text(v.astype(np.int64), block.groups) for v in values], block.wrong + (_per_text(~known, block.groups) > 0) * _MISSING], 1))
                shown.append(block.shown())
            numbers, done = np.concatenate(new), len(words.blocks)
            sums = np.stack([_per_text(numbers[at, i], many) for i in range(6)], 1)
            wrong = sums[:, 5] % _MISSING > 0
            if (sums[~wrong, 5] > 0).any():
                raise ValueError("an id pair of the second pass is not in the table of the first")
            sums[wrong] = 0
            parts = pa.concat_arrays(shown).take(pa.array(at)) if shown else pa.array([], pa.string())
            shown = [pa.concat_arrays(shown)] if shown else shown
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(many)]), pa.int32()), parts), ";")
            digests = ["" if x or not n else hashlib.sha256(t.as_buffer()).hexdigest() for t, x, n in zip(joined, wrong.tolist(), many.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(sums[:, i]) for i in (0, 1, 2, 2, 3, 4)], pa.array(digests, pa.string())], ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])
            if words.full:
                words.forget()
                numbers, shown, done = np.zeros((0, 6), np.int64), [], 0

    return of


def alignment_report(docs: DataFrame, tokenizer_a: str, tokenizer_b: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every document."""
    hash_, counts = pair_counts(docs, tokenizer_a, tokenizer_b, text_col=text_col)
    table = docs.sparkSession.sparkContext.broadcast((hash_, counts, best_of(hash_, counts)))
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(_reported((tokenizer_a, tokenizer_b), table), REPORT)


def pair_table(docs: DataFrame, tokenizer_a: str, tokenizer_b: str, *, text_col: str = "text") -> DataFrame:
    """(a long, b long, n long, best boolean): every linked id pair with its count, at most ``most_pairs`` rows."""
    hash_, counts = pair_counts(docs, tokenizer_a, tokenizer_b, text_col=text_col)
    spark = docs.sparkSession
    frame = pa.table({"a": hash_.keys >> _SHIFT if hash_.n else np.empty(0, np.int64), "b": hash_.keys & ((1 << _SHIFT) - 1) if hash_.n else np.empty(0, np.int64), "n": counts, "best": best_of(hash_, counts)})
    return spark.createDataFrame(frame)
