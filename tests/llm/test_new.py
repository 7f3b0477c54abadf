"""Personal data, whitening and alignment against brute force."""

import bisect
import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from formbook.llm import align, pii, whiten

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# --- alignment ---------------------------------------------------------------
def plain_alignment(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    a_all, b_all = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a_all.encode_special_tokens = True
    letters, names = align.byte_letters(), {i: t for t, i in a_all.get_vocab().items()}
    groups, count = [], Counter()
    for t in texts:
        a = a_all.encode(" " + t, add_special_tokens=False).ids if t else []
        b = b_all.encode(t) if t else []
        raw_a = [bytes(letters[c] for c in names[i]) for i in a]
        raw_b = [align.piece_bytes(b_all.id_to_piece(i)) for i in b]
        if not t or not b"".join(raw_a) == b"".join(raw_b) == (" " + t).encode():
            groups.append(None)
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in raw_a]).tolist(), np.cumsum([len(x) for x in raw_b]).tolist()
        own, i, j = [], 0, 0
        for e in sorted(set(ends_a) & set(ends_b)):
            i2, j2 = bisect.bisect_right(ends_a, e), bisect.bisect_right(ends_b, e)
            own.append((a[i:i2], b[j:j2]))
            i, j = i2, j2
        count.update((x[-1], y[-1]) for x, y in own)
        groups.append(own)
    most = defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    out = []
    for own in groups:
        if own is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n = [count[x[-1], y[-1]] for x, y in own]
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in own)
        out.append((sum(len(x) for x, _ in own), sum(len(y) for _, y in own), len(own), len(own), sum(k == most[y[-1]] for k, (_, y) in zip(n, own, strict=True)), sum(n), hashlib.sha256(shown.encode()).hexdigest()))
    return out, count


def test_alignment_against_whole_texts(spark):
    rng = random.Random(3)
    odd = [*"ab Z'9.\n\t　 \xa0é中😀_-<>|", "don't ", "'s", "\x1c", "᠎", "​", "<0x41>", "<s>", "<|endoftext|>", "\x85", "  ", " ", "12", "̂", "\r\n"]
    texts = ["".join(rng.choice(odd) for _ in range(rng.randrange(1, 60))) for _ in range(400)]
    texts += [None, "", " ", "\n", "a▁b", "▁", "good a▁b good", "x" * 5000, "word " * 3000, "word", "word", "the end of the end"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("keys", F.lit(1)).repartition(5)
    got = {r.doc_id: tuple(r)[1:] for r in align.alignment_report(frame, BYTES, PIECES).collect()}
    expect, count = plain_alignment(texts)
    assert [got[i] for i in range(len(texts))] == expect
    pair = align._pair((BYTES, PIECES))
    assert len(count) <= align.most_pairs(pair.bytes_a, pair.bytes_b) < 1_000_000
    table = {(r.a, r.b): r.n for r in align.pair_table(frame, BYTES, PIECES).collect()}
    assert table == dict(count)


def test_alignment_of_little(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert align.alignment_report(none, BYTES, PIECES).count() == 0
    empty = spark.createDataFrame([(None, None), (1, "")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.n_a, r.groups_sha256) for r in align.alignment_report(empty, BYTES, PIECES).collect()) == [(0, 0, ""), (1, 0, "")]


def test_words_are_forgotten_and_learned_again(monkeypatch):
    monkeypatch.setattr(align, "KEPT_WORDS", 50)
    words = align.Words(align._pair((BYTES, PIECES)))
    import pyarrow as pa

    for i in range(20):
        at, many = words.numbers(pa.array([f"w{i} v{j} u{j * i} " for j in range(10)]))
        assert len(at) == many.sum() and at.max() < words.n
        if words.full:
            words.forget()
    assert words.n <= 100


def test_perfect_hash():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 50, 20_000))
    found = align.PerfectHash(keys)
    assert sorted(found.find(keys).tolist()) == list(range(len(keys)))
    others = np.setdiff1d(rng.integers(0, 1 << 50, 20_000), keys)
    assert (found.find(others) == -1).all()
    assert align.PerfectHash(np.empty(0, np.int64)).find(keys).max() == -1


# --- whitening ---------------------------------------------------------------
def plain_whitening(rows):
    x = [(i, tuple(int(np.floor(256 * float(c))) for c in v)) for i, v in rows if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v)]
    fit = np.array(sorted({v for _, v in x}), float)
    n, total = len(fit), [sum(int(c) for c in col) for col in fit.T]
    centred = fit - fit.mean(0)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return x, n, total, values[::-1], vectors[:, ::-1]


def test_whitening_against_eigh(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(400, 12)) @ rng.normal(size=(12, 12)) * np.geomspace(1, 1e-2, 12) + 3
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[7][1]) for i in range(150)] + [(2000, None), (2001, []), (2002, [1.0] * 5), (2003, [None] + [1.0] * 11), (2004, [float("nan")] * 12), (2005, [float("inf")] * 12), (2006, [0.0] * 12), (2007, [-0.0] * 12), (None, rows[3][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("x", F.lit("clash")).repartition(6)
    got = whiten.whiten(frame).collect()
    x, n, total, values, vectors = plain_whitening([r for r in rows if r[1] is None or len(r[1]) != 5])
    assert len(got) == 4 * len(x) and {r.n for r in got} == {n} and {r.component for r in got} == {1, 2, 3, 4}
    mean = np.array(total, float) / n
    of = defaultdict(list)
    for i, v in x:
        of[i].append(v)
    sign = {}
    for r in got:
        v = of[r.vec_id][0]
        assert r.deviation == sum((n * c - s) ** 2 for c, s in zip(v, total, strict=True)) == int(r.deviation_exact)
        k = r.component - 1
        expect = (np.array(v) - mean) @ vectors[:, k] / np.sqrt(values[k])
        if abs(expect) > 1e-3:
            sign.setdefault(k, np.sign(expect) * np.sign(r.whitened))
        assert abs(sign.get(k, 1) * r.whitened - expect) < 1e-9 or abs(expect) <= 1e-3
        assert abs(r.explained / (values[k] / values.sum()) - 1) < 1e-9 and r.identity_error < 1e-9


def test_jacobi_keeps_small_values():
    rng = np.random.default_rng(0)
    for d in (1, 2, 5, 33):
        q, _ = np.linalg.qr(rng.normal(size=(d, d)))
        a = q * np.geomspace(1, 1e-6, d) @ q.T
        values, vectors = whiten.jacobi(whiten.pivoted_cholesky(a))
        assert np.allclose(values, np.geomspace(1, 1e-6, d), rtol=1e-8)
        assert np.allclose(vectors.T @ vectors, np.eye(d), atol=1e-12) and np.allclose(a @ vectors, vectors * values, atol=1e-12)
    low = rng.normal(size=(9, 3))
    values, vectors = whiten.jacobi(whiten.pivoted_cholesky(low @ low.T))
    assert len(values) == 3 and np.allclose(vectors * values @ vectors.T, low @ low.T)


def test_whitening_of_little(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]):
        assert whiten.whiten(spark.createDataFrame(rows, schema)).count() == 0
    two = whiten.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 2.0])], schema)).collect()
    assert [r.component for r in two] == [1, 1] and {round(abs(r.whitened), 9) for r in two} == {1.0} and abs(two[0].explained - 1) < 1e-12
    large = whiten.whiten(spark.createDataFrame([(1, [1e12, 2.0]), (2, [3e12, 2.0]), (3, [1e300, 1.0])], "vec_id long, embedding array<double>")).collect()
    assert [r.vec_id for r in large] == [1, 2] and large[0].deviation is None and int(large[0].deviation_exact) == (2 * 256 * 10**12) ** 2


# --- personal data -----------------------------------------------------------
PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            check = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d)))
            if kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")) or kind == "card" and 13 <= len(d) <= 19 and check % 10 == 0 or kind == "phone" and 9 <= len(d) <= 15:
                out.append((k, *m.span()))
    return out


def test_base_spans_against_patterns():
    rng = random.Random(4)
    bits = [*"aB0123456789.@-+ ()_%", "1.2.3.4", "4111 1111 1111 1111", "a@b.c", "+1 (017) 555-7713", "٣", "é", "\n", "0004.0.0.255", "256.1.1.1"]
    for _ in range(20_000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 30)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_patterns_are_linear():
    for text in ("a" * 300_000, "1" * 300_000, "a.b@" * 80_000, "+1" * 150_000, "1." * 150_000, "a@b" * 100_000, "1 " * 150_000):
        pii.base_spans(text)
        pii.stretches(text)


def people(seed, n):
    rng = random.Random(seed)
    words = "an the of thing reon estion whor onder ation ser ly mar ton el grav und der die".split()
    prose = lambda k: " ".join(rng.choice(words) for _ in range(k))
    digit = lambda k: "".join(rng.choice("0123456789") for _ in range(k))

    def card():
        d = digit(15)
        return next(d + c for c in "0123456789" if pii.luhn(d + c))

    def one(kind):
        if kind == 0:
            return f"{rng.choice(words)}.{digit(2)}@mail{digit(1)}.example.com"
        return ".".join(str(rng.randrange(256)) for _ in range(4)) if kind == 1 else card() if kind == 2 else f"+1 ({digit(3)}) 555-{digit(4)}"

    return [(k := i % 4, prose(rng.randrange(3, 30)) + " ", one(k), " " + prose(rng.randrange(3, 30))) for i in range(n)]


def test_tagger_finds_other_forms(spark):
    tagger = pii.train(people(1, 240))
    rng, right, real, wrong = random.Random(9), 0, 0, 0
    for kind, before, span, after in people(2, 200):
        other = pii.rewritten(kind, span, rng)
        text = before + other + after
        base = pii.base_spans(text)
        found = base + pii.reconciled(base, pii.decode_stretches(tagger, [pii.stretches(text)])[0], lambda a, b, t=text: t[max(0, a) : b])
        right += (kind, len(before), len(before) + len(other)) in found
        real += 1
        text = before + pii.decoy(rng) + after
        base = pii.base_spans(text)
        wrong += len(pii.reconciled(base, pii.decode_stretches(tagger, [pii.stretches(text)])[0], lambda a, b, t=text: t[max(0, a) : b]))
    assert right >= 0.8 * real and wrong <= 0.02 * real, (right, wrong)


def test_crf_against_all_label_rows():
    from itertools import product

    rng = np.random.default_rng(3)
    tagger = pii.Tagger(4)
    tagger.params = {k: v + rng.normal(size=v.shape).astype(np.float32) * 0.3 for k, v in tagger.params.items()}
    x = rng.integers(0, pii.CODES, (2, 4))
    e, t = tagger.emissions(x), tagger.params["t"] + pii.allowed()
    labels, marginal = tagger.decode(x)
    for r in range(2):
        score = {}
        for y in product(range(pii.LABELS), repeat=4):
            own = np.array(y)
            score[y] = e[r, np.arange(4), own].sum() + (tagger.params["s"] + pii.allowed()[0])[own[0]] + t[own[:-1], own[1:]].sum()
        best = max(score, key=score.get)
        assert tuple(labels[r]) == best
        top = max(score.values())
        total = sum(np.exp(v - top) for v in score.values())
        for i in range(4):
            assert abs(marginal[r, i] - sum(np.exp(v - top) for y, v in score.items() if y[i] == best[i]) / total) < 1e-6
    # One gradient of each table against differences.
    tagger.params = {k: v.astype(float) for k, v in tagger.params.items()}
    y = np.array([[0, 1, 2, 0], [3, 4, 4, 0]])
    _, grads = tagger.loss(x, y)
    for k, at in (("x", (0, x[0, 1], 3)), ("u", (1, 2, 5)), ("o", (3, 1)), ("b", (2,)), ("t", (1, 2)), ("s", (0,))):
        p, step = tagger.params[k], 1e-4
        p[at] += step
        up = tagger.loss(x, y)[0]
        p[at] -= 2 * step
        down = tagger.loss(x, y)[0]
        p[at] += step
        assert abs((up - down) / (2 * step) - grads[k][at]) < 1e-4


def test_pii_report(spark):
    rows = [(i, b + s + a) for i, (_, b, s, a) in enumerate(people(5, 120))] + [(500, None), (501, ""), (None, "call +1 (017) 555-7713"), (502, "no numbers here"), (503, "1 " * 5000), (3, "a.12@mail1.example.com"), (504, "write to ann.31 (at) mail4.example.com today")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("base", F.lit(1)).repartition(4)
    got = pii.pii_report(frame).collect()
    assert len(got) == len(rows)
    texts = defaultdict(list)
    for i, t in rows:
        texts[i].append(t or "")
    for r in got:
        fits = [b for b in map(plain_spans, texts[r.doc_id]) if hashlib.sha256(",".join(f"{pii.KINDS[k]}:{a}:{e}" for k, a, e in b).encode()).hexdigest() == r.base_sha256]
        assert fits
        counts = Counter(k for k, _, _ in fits[0])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(counts[k] for k in range(4))
        spans = [(pii.KINDS.index(k), int(a), int(b)) for k, a, b in (s.split(":") for s in r.spans.split(",") if s)]
        assert spans == sorted(spans) and set(fits[0]) <= set(spans) and len(spans) == len(fits[0]) + r.n_added
    by_id = {r.doc_id: r for r in got}
    assert by_id[502].spans == "" and by_id[500].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert by_id[504].spans == "email:9:38", by_id[504].spans
    assert pii.pii_report(frame.limit(0)).count() == 0


def test_reconciled():
    of = lambda a, b: "4111111111111111"[: b - a] if b - a > 1 else " "
    assert pii.reconciled([], [(2, 10, 26, 0.9), (2, 10, 20, 0.95)], of) == [(2, 10, 26)]
    assert pii.reconciled([(0, 20, 30)], [(2, 10, 26, 0.9)], of) == []
    assert pii.reconciled([], [(2, 10, 26, 0.5)], of) == []


def test_stretches_cover_all_windows():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice("x" * 80 + "1") for _ in range(rng.randrange(0, 900)))
        parts = pii.stretches(text)
        windows = {a + at for a, t in parts for at in range(0, max(1, len(t) - pii.STEP), pii.STEP)}
        need = {at for at in range(0, max(1, len(text) - pii.STEP), pii.STEP) if "1" in text[at : at + pii.WINDOW]}
        assert need <= windows and all(text[a : a + len(t)] == t for a, t in parts)


def test_windows_without_digits_are_decoded():
    """Addresses written out, without a digit or an at sign within a thousand characters; before, their windows were passed over."""
    rng = random.Random(6)
    words = "an the of thing reon estion whor onder ation ser ly mar ton el grav und der die".split()
    prose = lambda k: " ".join(rng.choice(words) for _ in range(k))
    who = lambda: f"{rng.choice(words)}.{rng.choice(words)}"
    tagger = pii.train([(0, prose(8) + " ", f"{who()}@mail.example.com", " " + prose(8)) for _ in range(150)])
    right = 0
    for _ in range(40):
        before, span = prose(250) + " ", f"{who()}(at)mail.example.com"
        text = f"{before}{span} {prose(250)}"
        found = pii.reconciled([], pii.decode_stretches(tagger, [pii.stretches(text)])[0], lambda a, b, t=text: t[max(0, a) : b])
        right += found == [(0, len(before), len(before) + len(span))]
    assert right >= 30, right


def test_screen_keeps_every_window_with_labels():
    rng = np.random.default_rng(5)
    for seed in range(20):
        tagger = pii.Tagger(4, seed)
        tagger.params |= {k: rng.normal(size=tagger.params[k].shape).astype(np.float32) for k in "ts"}
        tagger.params["b"][0] = rng.normal() + 2
        x = rng.integers(1, pii.CODES, (60, 30))
        labels, _ = tagger.decode(x)
        assert not ((labels != 0).any(1) & ~tagger.may_hold(tagger.by_label(x))).any()


def test_windows_left_out_change_nothing(monkeypatch):
    """Taggers that find spans everywhere: the spans added are those of all windows. Before, prose without an anchor went through the network too."""
    rng, numbers = random.Random(8), np.random.default_rng(8)
    bits = ["word", "an", " at ", "(at)", " [ AT ]", " at\n", "＠", " @ ", ".", " . ", "[dot]", " dot ", "(.)", "x-1", "mail", "example", "com", "10", "[.]", "4111", " 1111", "/1111", "1111", "555", "-", " ", " ", "٣", "\u2003"]
    prose = lambda k: " ".join(rng.choice("an the of thing look at that dot reon. ation meet".split()) for _ in range(k))
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 20))).join([prose(rng.randrange(0, 60)), prose(rng.randrange(0, 60))]) for _ in range(400)] + ["", "7", "x" * 48 + "1"]
    of = lambda text: lambda a, b: text[max(0, a) : b]
    added = 0
    for seed in range(6):
        tagger = pii.Tagger(4, seed)
        tagger.params |= {k: numbers.normal(size=tagger.params[k].shape).astype(np.float32) for k in "ts"}
        tagger.params["t"][0, 1 + 2 * (seed % 4)] += 3 * (seed % 2)
        tagger.params["t"][1 + 2 * (seed % 4) :, 2 + 2 * (seed % 4)] += 4
        spans = lambda: [pii.reconciled([], f, of(t), 0.0) for t, f in zip(texts, pii.decode_stretches(tagger, [pii.stretches(t) for t in texts]), strict=True)]  # noqa: B023, E731
        with monkeypatch.context() as m:
            m.setattr(pii, "plausible", lambda kind, text: bool(pii.AT.search(text) if kind == 0 else pii._digits(text)))  # the least that the check asks
            few = spans()
            m.setattr(pii, "anchored", lambda text: np.ones(pii._count(text), bool))
            assert few == spans()
        added += sum(map(len, few))
    assert added > 100, added
    # Whatever the check takes for an address holds an at that counts.
    for _ in range(20_000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(3, 9))).strip()
        assert not pii.plausible(0, text) or pii.AT.search(text), text
    for text in ("@ " * 150_000, "@" + "a" * 300_000, " at" * 100_000, "at " + "] " * 150_000, "@a (" * 80_000):
        pii.anchored(text)
    shown = []
    monkeypatch.setattr(pii.Tagger, "by_label", lambda self, x: shown.append(len(x)) or np.zeros((x.shape[1], pii.LABELS, len(x)), np.float32))
    pii.decode_stretches(pii.Tagger(4), [[(0, "look at that thing. " * 500 + "no. 7")]])
    assert sum(shown) <= 2
