"""The corpus pipeline's stages on a small table."""

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_stages_in_order(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "mixing", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == columns
        rows = docs.collect()
        if name != "mixing":
            assert len({r.doc_id for r in rows}) == len(rows) <= before
        if name == "toxicity":
            assert len(rows) >= before - 2 * len(toxic)
        before = len(rows)
    kept = {}
    for r in docs.collect():
        kept[r.doc_id] = kept.get(r.doc_id, 0) + 1
    pieces = corpus_pipeline.packing(spark, docs, SF).collect()
    starts = {}
    for p in pieces:
        starts.setdefault(p.doc_id, []).append(p.start)
    assert {i: s.count(0) for i, s in starts.items()} == kept


def plain_lines(docs):
    import re

    blank = " \t\n\x0b\x0c\r"
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(blank).translate(lower)
    holders = {}
    for i, t in docs.items():
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= 20:
                holders.setdefault(k, []).append(i)
    lost = {k: max(v) for k, v in holders.items() if len(v) >= 3}
    assert re.fullmatch("[^A-Z]*", "".join(lost))
    return {i: t if t is None else "\n".join(x for x in t.split("\n") if lost.get(key(x), i) == i) for i, t in docs.items()}


def plain_near(docs):
    import re

    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, t in docs.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower))
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(docs)
    for a in range(len(ids)):
        for b in range(a):
            x, y = sets[ids[a]], sets[ids[b]]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = find(ids[a]), find(ids[b])
                root[max(p, q)] = min(p, q)
    return {i: t for i, t in docs.items() if find(i) == i}


def plain_mix(rows):
    """doc_id to copies, of (doc_id, text, source): weighted fair queueing entry by entry, documents whole."""
    import hashlib
    import re
    from collections import Counter

    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in rows}
    sources = sorted({s for *_, s in rows}, key=lambda s: (s is None, s or ""))
    weight = {s: (5.0, 2.0, 1.0)[k % 3] for k, s in enumerate(sources)}
    total = {s: sum(size[i] for i, _, x in rows if x == s) for s in sources}
    budget, target, left = 1.5 * sum(total.values()), {}, set(sources)
    rest = budget
    while left:
        level = rest / sum(weight[s] for s in left)
        full = {s for s in left if weight[s] * level >= 2 * total[s]}
        if not full:
            target |= {s: weight[s] * level for s in left}
            break
        target |= {s: 2.0 * total[s] for s in full}
        rest -= sum(2.0 * total[s] for s in full)
        left -= full
    entries = []
    for s in sources:
        at = 0
        own = sorted((hashlib.md5(f"11:{i}".encode()).hexdigest(), i) for i, _, x in rows if x == s)
        for _, i in own:
            at += size[i]
            for epoch in (0, 1):
                if size[i] and target[s] > 0:
                    stop = at + epoch * total[s]
                    entries.append((stop / target[s], s is None, s or "", stop, i))
    served, taken = 0, Counter()
    for *_, i in sorted(entries):
        if served + size[i] > budget:
            break
        served += size[i]
        taken[i] += 1
    return taken


def test_stages_against_brute_force(spark):
    """Each stage over what the one before kept, held against plain loops."""
    import zlib
    from collections import Counter, defaultdict

    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    from formbook.llm.toxicity import label_chain

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)

    def run(name, frame):
        return corpus_pipeline.materialize(stages[name](spark, frame, SF), f"brute-{name}")

    chain = label_chain(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    ids = sorted(rows)
    p = chain.probabilities([rows[i].text for i in ids])[:, -1]
    clean = run("toxicity", docs)
    kept = {r.doc_id: r.text for r in clean.collect()}
    assert kept == {i: rows[i].text for i, q in zip(ids, p, strict=True) if q < chain.thresholds[-1]}
    lines = run("line_dedup", clean)
    got = {r.doc_id: r for r in lines.collect()}
    want = plain_lines(kept)
    assert {i: r.text for i, r in got.items()} == want and sum(want[i] != kept[i] for i in kept) > 0
    assert all(r.n_chars == len(r.text or "") for i, r in got.items() if want[i] != kept[i])
    near = run("near_dedup", lines)
    first = plain_near(want)
    assert {r.doc_id: r.text for r in near.collect()} == first and len(first) < len(want)
    mixed = run("mixing", near)
    copies = Counter(r.doc_id for r in mixed.collect())
    assert copies == plain_mix([(i, t, rows[i].source) for i, t in first.items()])
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces, places = defaultdict(Counter), defaultdict(list)
    for r in stages["packing"](spark, mixed, SF).collect():
        pieces[r.doc_id][r.start, r.length, r.ids_crc32, r.doc_tokens] += 1
        places[r.sequence_id].append((r.offset, r.length))
    for i, n in copies.items():
        ids = np.array([*plain.encode(first[i] or "", add_special_tokens=False).ids, 1], "<u4")
        assert all(c == n and zlib.crc32(ids[a : a + k].tobytes()) == crc and m == len(ids) for (a, k, crc, m), c in pieces[i].items())
        assert sum(k for _, k, _, _ in pieces[i]) == len(ids)
    for parts in places.values():
        ends = 0
        for offset, length in sorted(parts):
            assert offset == ends
            ends += length
        assert ends <= 2048


def test_stages_with_clashing_columns(spark):
    """Helper names of older code as columns, nulls, repeated rows, no n_chars: nothing breaks and the columns stay."""
    rows = [(1, "the one text of five words and more", "a"), (1, "the one text of five words and more", "a"), (None, None, None), (3, "", "b"), (4, "another text that is short enough here", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for c in ("_key", "_id", "_size", "_times", "_words", "_copy", "_lost", "_doc", "_salt", "n_lines", "size", "keys"):
        docs = docs.selectExpr("*", f"7 AS {c}")
    stages = dict(corpus_pipeline.STAGES)
    for name in ("line_dedup", "near_dedup", "mixing"):
        out = stages[name](spark, docs, SF)
        assert out.columns == docs.columns, name
        got = out.collect()
        assert all(r["_key"] == 7 and r["n_lines"] == 7 for r in got), name
        assert len(got) == {"line_dedup": 5, "near_dedup": 4}.get(name, len(got))
        assert stages[name](spark, docs.limit(0), SF).count() == 0
