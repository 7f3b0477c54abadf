"""Toxicity, nearest neighbours, packing, near-dedup, HTML, media and the pipeline against brute force."""

import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from formbook.llm import ann, html, media, minhash, packing, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
BPE = public_tokenizers.path("word_bpe_49k.json")


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t) if t else 0) for i, t, s in rows], DOCS)


def prose(seed, n):
    rng = random.Random(seed)
    return [rng.choice("an the of thing reon estion whor onder ation ser ly mar ton el grav".split()) + rng.choice(["", "ly", "ed", "s"]) + str(rng.randrange(40)) for _ in range(n)]


# --- toxicity ---------------------------------------------------------------
def test_chain_catches_and_spares(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(600):
        words = prose(i, rng.randrange(8, 120))
        bad, junk = i % 9 == 0, i % 7 == 0
        if bad:
            for w in ("zorgwicht", "blatherskip", "zorgwichtig")[: 1 + i % 3]:
                words.insert(rng.randrange(len(words)), w)
        text = " ".join(words).upper() + "!!!" if junk else " ".join(words)
        rows.append((i, text, "s"))
        if i < 450:
            labels.append((i, int(not junk), int(bad)))
    rows += [(900, None, "s"), (901, "", None), (5, rows[5][1], "s")]
    labels += [(900, None, 1), (None, 1, 1), (77777, 1, 1)]
    frame = docs(spark, rows).withColumn("toxic", F.lit("clash"))
    truth = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    chain = toxicity.label_chain(frame, truth)
    got = {r.doc_id: r for r in toxicity.score(frame, chain).collect()}
    held = range(450, 600)
    assert sum(got[i].toxic != (i % 9 == 0) for i in held) <= 3
    assert len(got) == 602 and not got[900].toxic and not got[901].toxic
    kept = toxicity.without_toxic(frame, chain)
    assert kept.columns == frame.columns and kept.count() == len(rows) - sum(got[r[0]].toxic for r in rows)


def test_logistic_against_plain_descent():
    rng = np.random.default_rng(4)
    dense = np.hstack([rng.normal(size=(300, 2)), np.ones((300, 1))])
    indices = [np.flatnonzero(rng.random(12) < 0.2) for _ in range(300)]
    x = np.zeros((300, 15))
    for i, js in enumerate(indices):
        x[i, js] = 1
    x[:, 12:] = dense
    y = (x[:, 0] + x[:, 3] - x[:, 12] + rng.normal(size=300) > 0.5).astype(float)
    use, columns = np.arange(300) % 5 != 0, np.arange(12) != 3
    got = toxicity.logistic(toxicity.Rows(indices, dense, 12), y, use, columns, rounds=2000)
    keep = np.append(columns, [True] * 3)
    scale = np.where(keep, 1 / np.sqrt(np.maximum((x[use] ** 2).sum(0), 1e-9)), 0)
    w = np.zeros(15)
    for _ in range(40000):
        penalty = np.append(np.full(14, 0.002), 0.0)
        w -= 0.5 * (scale * (x[use].T @ (toxicity.sigmoid(x[use] @ (scale * w)) - y[use])) + penalty * w)
    assert got[3] == 0 and np.allclose(got, w * scale, atol=1e-3)


def test_chain_takes_part_labels_and_feeds_probabilities_on(spark):
    rows = [(i, " ".join(prose(i, 30)) + (" zorg" if i % 3 == 0 else ""), "s") for i in range(300)]
    labels = [(i, None if i % 2 else int(i % 3 != 0), int(i % 3 == 0)) for i in range(300)]  # quality is unknown for half of them
    chain = toxicity.label_chain(docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert "zorg" in chain.vocabulary and [len(w) for w in chain.weights] == [len(chain.vocabulary) + 6, len(chain.vocabulary) + 7]
    assert chain.weights[1][-2] > 0 and all(q["recall"] > 0.97 and q["false_positives"] < 0.03 for q in chain.quality)


def test_chain_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    frame = docs(spark, [(1, "a b", "s")])
    chain = toxicity.label_chain(frame, none)
    assert not toxicity.score(frame, chain).first().toxic and toxicity.without_toxic(frame, chain).count() == 1
    assert toxicity.score(frame.limit(0), chain).count() == 0


# --- nearest neighbours -------------------------------------------------------
def test_ann_recall_and_scores(spark):
    rng = np.random.default_rng(2)
    x = (rng.normal(size=(40, 16))[rng.integers(0, 40, 3000)] * 2 + rng.normal(size=(3000, 16))).astype(np.float32)
    x[1000:2000] = x[1000]  # a vector that a third of all rows hold
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(3000, None), (3100, [0.0] * 16), (3200, [float("nan")] * 16), (3300, [None] * 16), (3400, []), (None, x[1].tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("part", F.lit(1))
    got = defaultdict(list)
    for r in ann.nearest(frame, F.col("vec_id") % 50 == 0, parts=16, block=500).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    hit = total = 0
    y = x.astype(float)
    for q in range(0, 3000, 50):
        d = np.sqrt(((y - y[q]) ** 2).sum(1))
        d[q] = np.inf
        true = np.lexsort((np.arange(3000), d))[:10]
        assert len(got[q]) == 10 and [s for _, s in got[q]] == pytest.approx([d[v] for v, _ in got[q]])
        assert got[q] == sorted(got[q], key=lambda p: (p[1], p[0]))
        hit += len(set(true) & {v for v, _ in got[q]})
        total += 10
    assert set(got) == set(range(0, 3000, 50)) and hit / total >= 0.9


def test_ann_small_and_empty(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (100, [1.0, 1.0])], "vec_id long, embedding array<float>")
    rows = ann.nearest(frame, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in rows] == [(0, 1, 100), (0, 2, 1), (100, 1, 0), (100, 2, 1)]
    assert [r.score for r in rows] == pytest.approx([1.0, 2**0.5, 1.0, 1.0])
    assert ann.nearest(frame.limit(0), F.col("vec_id") % 100 == 0).count() == 0


# --- packing ------------------------------------------------------------------
def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BPE)
    tokenizer.encode_special_tokens = True
    odd = ["", None, "It's <|endoftext|> they'll'd a'b", "ÄÖÜß İstanbul ŉ x y z\x1cq\x85r", "é café ́a", "日本語 テキスト，。", "a_b 12.5% x,y;z!? (q)", "\n\t ", "ALLCAPS... Mixed-Case?!", "don't 're x're 's"]
    rows = [(i, t, "s") for i, t in enumerate(odd)] + [(100 + i, " ".join(prose(i, 5 + i * 13 % 700)), "s") for i in range(80)] + [(500, " ".join(prose(5, 9000)), "s"), (None, "no id", None)]
    frame = docs(spark, rows).withColumn("start", F.lit("clash")).repartition(3)
    got = packing.pack(frame, BPE).collect()
    ids = {i: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t, _ in rows}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own) and r.ids_crc32 == zlib.crc32(own[r.start : r.start + r.length].tobytes())
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in (*pieces.values(), *sequences.values()):
        at = 0
        for start, length in sorted(own):
            assert start == at and length > 0
            at += length
    assert {i: sum(n for _, n in p) for i, p in pieces.items()} == {i: len(x) for i, x in ids.items()}
    filled = [sum(n for _, n in s) for s in sequences.values()]
    assert max(filled) <= 2048 and sum(filled) / (2048 * len(filled)) > 0.9
    assert packing.pack(frame.limit(0), BPE).count() == 0


def test_special_tokens_as_the_plain_call(spark, tmp_path):
    """The registered query and the pipeline's stage on documents that hold the literal text of added tokens."""
    from tokenizers import Tokenizer

    import corpus_pipeline
    from formbook.llm import queries

    tokenizer = Tokenizer.from_file(BPE)
    texts = ["end here <|endoftext|> next", "a<|endoftext|>b", "(<|startoftext|><|endoftext|>)", "<|ENDOFTEXT|> <|endoftext| endoftext|>", "Don<|endoftext|>'t é<|endoftext|>\u0301", "plain words"]
    frame = docs(spark, [(i, t, "s") for i, t in enumerate(texts)])
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    want = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}
    assert want[0] == [806, 763, 49407, 1131, 1]
    for got in (queries.op3_packing(spark, str(tmp_path)), corpus_pipeline.packing(spark, frame, str(tmp_path))):
        assert {r.doc_id: (r.doc_tokens, r.ids_crc32) for r in got.collect()} == {i: (len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in want.items()}


def test_plan_uses_every_piece_once():
    rng = np.random.default_rng(0)
    for trial in range(6):
        h = {int(b): int(n) for b, n in zip(*np.unique(rng.integers(1, 129 if trial % 2 else 40, 50 * 9**trial % 7000 + 1), return_counts=True), strict=True)}
        used = defaultdict(int)
        for shape, times in packing.plan(h, 128, 3):
            assert sum(shape) <= 128
            for b in shape:
                used[b] += times
        assert used == h


# --- near duplicates ----------------------------------------------------------
def by_hand(rows, words, percent=80):
    sets = []
    for _, t, _ in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode().split()
        sets.append({tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), 10**9), d)
    return sorted((d, len(sets[i]), least[find(i)], least[find(i)] == d) for i, (d, _, _) in enumerate(rows))


def test_near_duplicates(spark):
    rng = random.Random(4)
    rows = []
    for g in range(12):
        base = prose(g, 60 + 20 * g)
        for c in range(1 + 3 * g):
            w = list(base)
            for _ in range(rng.randrange(0, 9)):
                w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
            rows.append((len(rows) * 7 % 997, " ".join(w).title() if c % 2 else " ".join(w), "s"))
    rows += [(2000, None, "s"), (2001, "", "s"), (2002, " \n ", "s"), (2003, "Two words", "s"), (2004, "two  WORDS", "s"), (2005, "ÄB", "s"), (2006, "äb", "s")]
    frame = docs(spark, rows).withColumn("class", F.lit(0)).repartition(4)
    for words in (4, 5):
        got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(frame, words=words).collect())
        assert got == by_hand(rows, words)
    kept = minhash.keep_first(frame, words=5)
    assert kept.columns == frame.columns and kept.count() == sum(k for *_, k in by_hand(rows, 5))
    assert minhash.near_duplicates(frame.limit(0)).count() == 0


def test_pivots_of_a_group_of_near_copies_are_few(spark):
    """Each of 300 near copies shares most bands with all; by the smallest class a class had several stars."""
    rng = random.Random(2)
    rows = [(c, b if c == 200 or rng.random() < 0.6 else 1000 + c * minhash.BANDS + b) for c in range(300) for b in range(minhash.BANDS)]
    banded = spark.createDataFrame(rows, "class long, band long")
    buckets = minhash.central_pivots(banded).collect()
    size, least = Counter(b for _, b in rows), {}
    for c, b in rows:
        least[b] = min(c, least.get(b, c))
    assert sorted((r.band, r["class"], r.n) for r in buckets) == sorted((b, c, size[b]) for c, b in rows if size[b] > 1)
    stars = lambda pivot: len({(pivot(r), r["class"]) for r in buckets if pivot(r) != r["class"]})
    assert stars(lambda r: r.pivot) == 299 and stars(lambda r: least[r.band]) > 600


def test_keep_first_keeps_one_row_of_each_component(spark):
    """Repeated ids, null ids, and an id of two texts of which one is a near copy."""
    a, b, c, d, e = (" ".join(prose(50 + i, 120)) for i in range(5))
    rows = [(1, a), (1, a), (2, a + " more"), (3, a), (3, d), (None, a), (7, b), (None, b), (None, b), (None, c), (None, c), (9, e), (9, e), (8, e), (8, e), (20, ""), (20, ""), (None, None), (None, " ")]
    frame = docs(spark, [(i, t, "s") for i, t in rows]).repartition(3)
    out = minhash.keep_first(frame, words=5)
    assert out.columns == frame.columns
    want = [(1, a), (3, d), (7, b), (None, c), (8, e), (20, ""), (20, ""), (None, None), (None, " ")]
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted(want, key=str)


def test_prefix_join_is_exact(spark):
    """Links that no star finds: members of one bucket are paired by the prefix join alone."""
    rng = random.Random(8)
    sets = {}
    for g in range(10):
        core = [rng.randrange(2**60) for _ in range(40)]
        for c in range(8):
            sets[f"{g}{c}".encode()] = core[rng.randrange(0, 6) :] + [rng.randrange(2**60) for _ in range(rng.randrange(0, 8))]
    members = spark.createDataFrame([(bytearray(k), bytearray(k), v) for k, v in sets.items()], "class binary, root binary, set array<bigint>")
    pairs = minhash.confirmed(minhash.prefix_pairs(members, 80), members.select("class", "set"), 80)
    got = {tuple(sorted((bytes(r.a), bytes(r.b)))) for r in pairs.collect()}
    want = {tuple(sorted((a, b))) for a in sets for b in sets if a < b and 5 * len(set(sets[a]) & set(sets[b])) >= 4 * len(set(sets[a]) | set(sets[b]))}
    assert got == want and want


# --- html ---------------------------------------------------------------------
PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header class="site"><a href=/>Home</a> <p>Site slogan, long enough to be taken for a paragraph of text.</p></header>
<nav><ul><li><a href=/a>A</a></li></ul></nav><div class="cookie-notice"><p>We use cookies, as everyone does, to make this site better for you.</p></div>
<div id="wrap"><div class="content"><h1>Head &amp; line</h1><p>First paragraph, with <b>bold</b>\n text, commas, and <a href="x">one link</a>.<br>Next line.
<p>Second paragraph &eacute;&#x41; is unclosed, but long enough to count, surely.<ul><li>item one<li>item two</ul><form><input><p>Sign up, now, for our very long newsletter text.</p></form>
<p>Short.</p></div><aside><p>Sidebar text that is long, with commas, to tempt the scorer a lot.</p></aside></div>
<div id="comments"><p>I think, as a reader, that this comment should not be in the text.</p></div><footer><p>Footer, copyright, and a long line of legal words.</p></footer><script>var t="</p>";</script></body></html>"""


def test_html_extraction(spark):
    want = "Head & line\n\nFirst paragraph, with bold text, commas, and one link. Next line.\n\nSecond paragraph éA is unclosed, but long enough to count, surely.\n\nitem one\n\nitem two\n\nShort."
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "<p>a</p>plain"), (5, "u", "<div>" * 3000 + "deep" + "</div>" * 3000), (None, "u", "<<a<b"), (1, "u", PAGE)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    got = html.main_text(frame).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert [r.text for r in got if r.page_id == 1] == [want, want]
    assert {r.page_id: r.text for r in got if r.page_id in (2, 3, 5)} == {2: "", 3: "", 5: "deep"}


def paragraphs(n, word="body"):
    return "".join(f"<p>This is {word} {i}, with some words, commas, and enough length to be counted as article text by any scorer.</p>" for i in range(n))


THREAD = "<div><span class='author'>Bob</span><time>now</time><p>I think this is a fine, fine article, thanks a lot for it, really.</p></div>" * 3
AWAY = ["article-comments", "post-comments", "entry-comments", "comment content", "main-sidebar", "main-nav", "post-share", "content-advert", "comments", "cookie-banner", "ad", "sideBarLeft"]
STAYS = ["share-of-market", "related", "register", "reply", "discussion", "search-results-section", "alert", "article-body", "post content"]


@pytest.mark.parametrize("inside", [True, False])
def test_html_names_of_other_parts(inside):
    whole = (lambda x: f"<body><article><h1>T</h1>{paragraphs(4)}{x}</article></body>") if inside else (lambda x: f"<body><div><div><h1>T</h1>{paragraphs(4)}</div>{x}</div></body>")
    want = html.extract(whole(""))
    assert want.count("body") == 4 and want.startswith("T")
    for name in AWAY:
        for part in ("<p>Other text, with a comma.</p>", THREAD, "<ul><li><a href=x>one</a><li><a href=y>two</a></ul>"):
            assert html.extract(whole(f"<div class='{name}'>{part}</div>")) == want, (name, part)
    for part in (f"<div class=discussion>{THREAD}</div>", f"<section id=comments><article class=comment>{paragraphs(2, 'reply')}</article></section>", "<div class=share><a href=x>Share</a> this</div>", "<div><a href=a>one</a> <a href=b>two</a> <a href=c>three</a></div>"):
        assert html.extract(whole(part)) == want, part


def test_html_keeps_article_text_whatever_its_name():
    for name in STAYS:
        got = html.extract(f"<body><nav>menu</nav><article><h1>T</h1>{paragraphs(3)}<section class='{name}'><h2>Head</h2>{paragraphs(2, 'part')}</section></article></body>")
        assert got.count("body") == 3 and got.count("part") == 2 and "Head" in got, name
        assert html.extract(f"<body><div class='has-sidebar {name}'><h1>T</h1>{paragraphs(5)}</div><div>footer</div></body>").count("body") == 5, name


def test_html_scores_decide_without_article():
    teaser = "<div><h3>Other</h3><p>Read on, it is nice.</p></div>"
    menu = "<div><ul>" + "".join(f"<li><a href=x>entry, number {i}, of a menu with long links</a>" for i in range(30)) + "</ul></div>"
    page = f"<body><div>{menu}<div><div><h1>T</h1><div>{paragraphs(3)}</div><div>{paragraphs(3, 'more')}</div></div>{teaser}</div></div><div>Copyright, all rights.</div></body>"
    got = html.extract(page)
    assert got.count("body") == 3 and got.count("more") == 3 and "menu" not in got and "Copyright" not in got and "Read on" not in got and got.startswith("T")
    # Of several articles the one with the most points.
    two = html.extract(f"<body><article>{paragraphs(1, 'teaser')}</article><div></div><main>{paragraphs(6)}</main></body>")
    assert two.count("body") == 6


def test_html_scores_against_brute_force():
    rng = random.Random(12)

    def tree(depth):
        if depth == 0 or rng.random() < 0.3:
            n = rng.randrange(1, 30)
            words = " ".join(rng.choice(["word", "wörter,", "x", "longer"]) for _ in range(n))
            return f"<p>{words}</p>" if rng.random() < 0.7 else f"<p><a href=x>{words}</a> {words[:20]}</p>"
        return "<div>" + "".join(tree(depth - 1) for _ in range(rng.randrange(1, 4))) + "</div>"

    for _ in range(60):
        order = html.prune(html.parse(f"<body>{tree(4)}{tree(4)}</body>"))
        scored = html.score(order)
        text = lambda n: "".join(c if isinstance(c, str) else text(c) for c in n.children)
        links = lambda n: text(n) if n.tag == "a" else "".join(links(c) for c in n.children if not isinstance(c, str))
        for node in scored:
            points = 0.0
            for leaf in order:
                inner = text(leaf)
                if leaf.tag == "p" and leaf.text_n >= 25:
                    chain, up = [], leaf.parent
                    while up is not None:
                        chain.append(up)
                        up = up.parent
                    if any(x is node for x in chain):
                        level = next(i for i, x in enumerate(chain) if x is node)
                        points += (1 + inner.count(",") + min(len(" ".join(inner.split())) / 100, 3)) * (1 - leaf.link_n / leaf.text_n) / [1, 2, 6, 9, 12, 15, 18, 21][level]
            assert node.points == pytest.approx(points * (1 - node.link_n / node.text_n), abs=1e-6)
            assert abs(node.link_n - len(links(node).strip())) <= 40 * text(node).count(" ")


# --- media --------------------------------------------------------------------
def lzw(samples, size):
    """A plain compressing encoder, to hold the decoder against."""
    clear, out, acc, n = 1 << size, bytearray(), 0, 0
    table, width, prefix = {bytes([i]): i for i in range(clear)}, size + 1, b""
    nxt = clear + 2

    def put(code):
        nonlocal acc, n
        acc |= code << n
        n += width
        while n >= 8:
            out.append(acc & 255)
            acc >>= 8
            n -= 8

    put(clear)
    for s in samples:
        if prefix + bytes([s]) in table:
            prefix += bytes([s])
            continue
        put(table[prefix])
        table[prefix + bytes([s])] = nxt
        if nxt == 1 << width and width < 12:
            width += 1
        nxt += 1
        if nxt == 4096:
            put(clear)
            table, width, nxt = {bytes([i]): i for i in range(clear)}, size + 1, clear + 2
        prefix = bytes([s])
    put(table[prefix])
    put(clear + 1)
    out.append(acc & 255)
    return bytes(out)


@pytest.mark.parametrize("size,n", [(2, 50), (2, 30000), (4, 9000), (8, 100), (8, 70000)])
def test_lzw_decodes_compressed_streams(size, n):
    rng = random.Random(n)
    samples = bytes(rng.randrange(1 << size) if rng.random() < 0.3 else 1 for _ in range(n))
    assert media.lzw_decode(lzw(samples, size), size, n) == samples


def gif(frames, w=4, h=4):
    head = b"GIF89a" + struct.pack("<HHBBB", w, h, 0x91, 0, 0) + bytes([0, 0, 0, 255, 0, 0, 0, 255, 0, 0, 0, 255])
    for box, samples, disposal, transparent, flags in frames:
        body = lzw(samples, 2)
        head += b"\x21\xf9\x04" + struct.pack("<BHB", disposal << 2 | (transparent is not None), 5, transparent or 0) + b"\0\x2c" + struct.pack("<HHHHB", *box, flags) + b"\x02" + bytes([len(body)]) + body + b"\0"
    return head + b"\x3b"


def test_gif_rules():
    data = gif([((0, 0, 4, 4), bytes([1] * 16), 1, None, 0), ((1, 1, 2, 2), bytes([2, 3, 3, 2]), 2, 3, 0), ((0, 0, 1, 1), bytes([3]), 3, None, 0), ((0, 0, 4, 4), bytes([0] * 4 + [1] * 4 + [2] * 4 + [3] * 4), 0, None, 0x40)])
    f = list(media.decode_gif(data))
    red, green, blue = [255, 0, 0, 255], [0, 255, 0, 255], [0, 0, 255, 255]
    assert [x.start_ms for x in f] == [0, 50, 100, 150] and (f[0].canvas == red).all()
    assert f[1].canvas[1, 1].tolist() == green and f[1].canvas[1, 2].tolist() == red
    assert f[2].canvas[1, 1].tolist() == [0, 0, 0, 0] and f[2].canvas[0, 0].tolist() == blue and f[2].canvas[0, 1].tolist() == red
    assert [f[3].canvas[i, 0].tolist() for i in range(4)] == [[0, 0, 0, 255], green, red, blue]  # interlaced: rows 0, 2, 1, 3


def test_streams_go_through_the_dictionary():
    text = " ".join(prose(4, 4000)).encode()
    payload = media.payload_of(text.decode())
    stored = media.encode_gif(payload)
    assert len(stored) < 0.7 * len(payload)
    size = max(2, len(set(payload)).bit_length())
    stream = media.lzw_encode(payload[:60000].translate(bytes(sorted(set(payload)).index(b) if b in payload else 0 for b in range(256))), size)
    # Fewer codes than samples: each code past the literals and the two marks is an entry of the dictionary.
    assert 8 * len(stream) / (size + 1) < 60000 / 1.5
    for wild in (bytes(range(256)) * 700, bytes(64), b"ab" * 40000, bytes([255]) * 64 * 5000):
        assert b"".join(f.canvas[f.box[1] : f.box[1] + f.box[3], :, 0].tobytes() for f in media.decode_gif(media.encode_gif(wild))) == wild


def test_repeated_frames_are_drawn_over_with_transparency(spark):
    rng = random.Random(6)
    segment = "".join(rng.choice("abcdefgh \n") for _ in range(media.WIDTH * media.HEIGHT))
    changed = "".join("X" if i % 9 == 0 else c for i, c in enumerate(segment))
    text = segment + changed + segment[::-1] + segment[:1000]
    raw = media.encode_gif(media.payload_of(text))
    shown = list(media.decode_gif(raw))
    control = [raw[i + 3] for i in range(len(raw)) if raw[i : i + 3] == b"\x21\xf9\x04"][:1]
    assert len(shown) == 4 and control == [1 << 2]  # the first frame stays, for the second is drawn over it
    assert raw.count(b"\x21\xf9\x04" + bytes([2 << 2 | 1])) >= 1  # the second is transparent in part, and disposed to the background
    plain = media.encode_gif(media.payload_of(changed))
    assert len(raw) < 2 * len(media.encode_gif(media.payload_of(segment))) + 2 * len(plain)
    r = media.media_report(docs(spark, [(1, text, "s"), (2, "short", "s")])).where("doc_id = 1").first()
    import hashlib

    payload = media.payload_of(text)
    assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and [f.height for f in r.frames] == [media.HEIGHT] * 3 + [-(-1000 // 64)]
    assert [sum(f.histogram) for f in r.frames] == [f.height * 64 for f in r.frames] and r.feature.startswith("frames=4;ms=400;hist=")


def test_broken_streams_stop():
    stream = media.lzw_encode(bytes([1, 2, 1, 2, 1, 2, 3] * 500), 2)
    whole = bytes([1, 2, 1, 2, 1, 2, 3] * 500)
    for cut in (0, 1, 5, len(stream) // 2):
        got = media.lzw_decode(stream[:cut], 2, 3500)
        assert whole.startswith(got)
    assert media.lzw_decode(b"\xff" * 50, 2, 100) == b""


def test_media_report(spark):
    rows = [(1, None, "s"), (2, "", "s"), (3, "héllo", "s"), (4, "x" * 300000, "s"), (5, "".join(map(chr, range(1, 3000))), None), (3, "héllo", "s"), (None, "n", "s")]
    got = media.media_report(docs(spark, rows).withColumn("media", F.lit(0))).collect()
    assert len(got) == len(rows)
    import hashlib

    for r in got:
        text = next(t for i, t, _ in rows if i == r.doc_id)
        raw = (text or "").encode()
        payload = raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        stored = media.encode_gif(payload)
        assert (r.media_bytes, r.media_sha256) == (len(stored), hashlib.sha256(stored).hexdigest())
    frames = media.frames(media.stored(docs(spark, rows)).where("media_id = 4")).orderBy("frame").collect()
    assert [f.start_ms for f in frames] == [100 * i for i in range(-(-300032 // (media.WIDTH * media.HEIGHT)))] and sum(sum(f.histogram) for f in frames) == 300032
    assert media.frames(spark.createDataFrame([(1, None), (2, bytearray(b"no gif"))], "media_id long, media binary")).count() == 0


def test_html_takes_time_linear_in_bad_pages():
    import time

    pages = {
        "nested": "<div>some text, here and now. " * 100_000, "quotes": '<a "' * 250_000, "quotes that end": '<a "' * 250_000 + '">', "inline": "<b>" * 20_000 + "<p>x y z" * 20_000,
        "unmatched": "<div>" * 50_000 + "</article>" * 50_000, "scoped": "<b><div>" + "<i>" * 50_000 + "</b>" * 50_000, "scripts": "<script " * 100_000, "declared": "<!" * 300_000,
        "headers": "<article>" + "<header>t. " * 50_000, "lists": "<ul><li>some text, here. " * 30_000, "comments": "<div class='comment'><span class='author'>a</span><time>d</time>" * 20_000, "links": "<div><a>link text</a>" * 30_000,
    }
    for name, page in pages.items():
        began = time.time()
        html.extract(page)
        assert time.time() - began < 20, name


def test_html_judges_blocks_by_build():
    body = "<p>" + "This is a paragraph of the article, with commas, and more words. " * 6 + "</p>"
    inside = lambda block: html.extract(f"<html><body><article><h1>T</h1>{body}{block}{body}</article></body></html>")
    for name in ("discussion", "more", "banner", "form", "alert"):
        assert "short real text." in inside(f"<section class='{name}'><h2>Part</h2><p>short real text.</p></section>"), name
    talk = "<div><span class='author'>A</span><time>1</time><p>I like it.</p></div>" * 3
    for name in ("responses", "talkback", "post-comments", "whatever"):
        assert "I like it." not in inside(f"<div class='{name}'>{talk}</div>"), name
    assert "Other story" not in inside("<div class='related-posts'><a href='x'>Other story</a> <a href='y'>Other story too</a></div>")
    assert "so x=1 holds" in inside("<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1 tex</annotation></math> holds</p>")
    assert "tex" not in inside("<p>so <math><mi>x</mi><annotation>tex</annotation></math></p>")


def test_frames_of_the_given_table_meet_disposal_and_transparency():
    """Documents of the given table in several frames, of which some are drawn over the one before; a frame that is not starts on an empty canvas."""
    import pyarrow.parquet as pq

    texts = pq.read_table("/root/testdata/sf0.1/documents.parquet").column("text").to_pylist()
    several = [t for t in texts if len(t or "") > 2 * media.WIDTH * media.HEIGHT]
    assert len(several) > 100
    drawn_over = disposed = 0
    for t in several[:1500]:
        payload = media.payload_of(t)
        raw = media.encode_gif(payload)
        marks = [raw[i + 3] for i in range(len(raw) - 7) if raw[i : i + 3] == b"\x21\xf9\x04" and raw[i + 7 : i + 9] == b"\x00\x2c"]
        drawn_over += any(m & 1 for m in marks)
        disposed += any(m >> 2 == 2 for m in marks)
        assert b"".join(f.canvas[f.box[1] : f.box[1] + f.box[3], :, 0].tobytes() for f in media.decode_gif(raw)) == payload
    assert drawn_over >= 1 and disposed > 100, (drawn_over, disposed)


def test_chain_against_plain_loops(spark):
    """Folds, vocabularies, out-of-fold feeding, thresholds and scores by plain loops over the same documents."""
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(240):
        words = prose(i, rng.randrange(8, 40))
        bad, junk = i % 5 == 0, i % 4 == 0
        if bad and rng.random() < 0.9:
            words.insert(rng.randrange(len(words)), "zorgwicht")
        text = " ".join(words) + ("!!!! 12" if junk and rng.random() < 0.9 else "")
        rows.append((i, text, "s"))
        labels.append((i, int(not junk) if i % 11 else None, int(bad)))
    rows += [rows[3]] * 40  # a row that is there many times trains once
    frame, truth = docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    chain = toxicity.label_chain(frame, truth)
    fold = {r.doc_id: r.f for r in truth.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(toxicity.FOLDS)).cast("int").alias("f")).collect()}
    texts = {i: t for i, t, _ in rows}
    ids = sorted(texts)
    y = np.array([[-1 if q is None else int(q == 0), t] for _, q, t in labels])

    def best_terms(held):
        use = [i for i in ids if fold[i] != held]
        score = {}
        for c in range(2):
            n = sum(y[i, c] >= 0 for i in use)
            pos = sum(y[i, c] == 1 for i in use)
            counts = defaultdict(lambda: [0, 0])
            for i in use:
                for t in toxicity.terms(texts[i]):
                    counts[t][0] += y[i, c] >= 0
                    counts[t][1] += y[i, c] == 1
            for t, (b, a) in counts.items():
                if b:
                    score[t] = max(score.get(t, 0.0), n * (a * n - b * pos) ** 2 / (b * pos * (n - b + 0.5) * (n - pos)))
        return {t for t in score if score[t] >= toxicity.LEAST_SCORE}

    most = defaultdict(int)
    for t in set().union(*[toxicity.terms(texts[i]) for i in ids]):
        most[t] = sum(max(sum(fold[i] == f and y[i, c] >= 0 and t in toxicity.terms(texts[i]) for i in ids) for c in range(2)) for f in range(toxicity.FOLDS))
    chosen = [{t for t in best_terms(held) if most[t] >= toxicity.LEAST_DOCS} for held in range(toxicity.FOLDS + 1)]
    every = sorted(set().union(*chosen))
    assert chain.vocabulary == {t: i for i, t in enumerate(sorted(chosen[-1]))}
    columns = [np.array([t in c for t in every]) for c in chosen]
    indices = [np.array(sorted(every.index(t) for t in toxicity.terms(texts[i]) if t in set(every)), np.int64) for i in ids]
    base, folds = np.array([toxicity.shape(texts[i]) for i in ids]), np.array([fold[i] for i in ids])
    seen = np.empty((len(ids), 0))
    for c in range(2):
        x = toxicity.Rows(indices, np.hstack([base, toxicity.logit(seen), np.ones((len(ids), 1))]), len(every))
        held = np.empty(len(ids))
        for f in range(toxicity.FOLDS):
            w = toxicity.logistic(x, np.maximum(y[:, c], 0), (y[:, c] >= 0) & (folds != f), columns[f])
            held[folds == f] = toxicity.sigmoid(x.dot(w))[folds == f]
        w = toxicity.logistic(x, np.maximum(y[:, c], 0), y[:, c] >= 0, columns[-1])
        assert np.allclose(chain.weights[c], np.concatenate([w[: len(every)][columns[-1]], w[len(every) :]]), atol=1e-6)
        use = y[:, c] >= 0
        tries = np.linspace(0.2, 0.8, 61)
        errors = [int(((held[use] >= t) != (y[use, c] == 1)).sum()) for t in tries]
        assert chain.thresholds[c] == tries[min(range(61), key=lambda j: (errors[j], abs(tries[j] - 0.5)))]
        seen = np.hstack([seen, held[:, None]])


def test_toxicity_sample_is_bounded_by_rows(spark):
    """One id with very many texts: no more than the sample trains."""
    rows = [(1, f"text number {i} of one id with words enough", "s") for i in range(3000)] + [(i, f"other text {i} here", "s") for i in range(2, 40)]
    truth = spark.createDataFrame([(i, i % 2, i % 3 == 0) for i in range(1, 40)], "doc_id long, quality int, toxic boolean").withColumn("toxic", F.col("toxic").cast("int"))
    chain = toxicity.label_chain(docs(spark, rows), truth, sample=100)
    assert len(chain.weights) == 2 and toxicity.score(docs(spark, rows).limit(50), chain).count() == 50
