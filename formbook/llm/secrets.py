"""Secret scan: base patterns, and sliding-window Shannon entropy per character class.

Everything is a column expression over one row, so the plan has no shuffle and
a hot source or a very long text only makes its own row longer. Arrays that lambdas read are bound
once (``bound``), running totals go by blocks of blocks, and base spans and candidates are merged by one sort, so a
row's time is about proportional to its text and matches.

The base patterns give the spans ``assign``, ``access`` and ``hex``. Besides, candidate
strings (runs of key-like characters as long as the window or longer) are scanned
with a window of ``window`` characters. The window's character counts are kept
up step by step: one character enters, one leaves, and the sum of c*log2(c),
from which the entropy follows, changes by these two terms alone. A candidate
is an ``entropy`` span when its best window reaches the threshold of its
character class, unless it overlaps a base span or is on the allow-list. A placeholder word suppresses
a candidate only where such words make up more than half of it.

Edge cases: a null text is empty and has no spans; repeated rows give repeated
results; other columns are not read; positions are code points.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The base patterns, in the order of their kinds.
BASE = {
    "assign": r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}
KINDS = [*BASE, "entropy"]
#: Runs of 20 or more key-like characters (the window's length).
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
#: Entropy in bits that the best window of a class must reach: hexadecimal digits with a letter and a digit, mere letters, letters and digits, the rest. Runs without a letter are no candidates.
THRESHOLDS = {r"(?=[a-fA-F]*[0-9])(?=[0-9]*[a-fA-F])[0-9a-fA-F]+": 3.0, r"[A-Za-z]+": 4.1, r"[A-Za-z0-9]+": 3.7, r"(?=[^0-9]*[0-9])(?=[^A-Za-z]*[A-Za-z])[A-Za-z0-9+/_=-]+": 3.9, r"(?=[^A-Za-z]*[A-Za-z])[A-Za-z+/_=-]+": 4.1}
#: Candidates that are no secrets: UUIDs, dates and versions; and (see PLAIN_PART) paths and joined words.
ALLOWED = [
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
    r"[0-9+/_=-]+[A-Za-z]{1,4}[0-9+/_=-]*",
]
#: Words of placeholders.
PLACEHOLDER = r"(?i)example|placeholder|changeme|x{4,}|0{4,}|0?123456[7890]*"
#: A candidate of several parts, each like this, is a path or a compound of words and numbers.
PLAIN_PART = r"^[A-Za-z]{0,20}[0-9]{0,8}$"
WINDOW = 20


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), where the value is computed once however often f reads it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def running(values: Column, combine: Callable[[Column, Column], Column], zero: Column, levels: int = 2, block: int = 32) -> Column:
    """Exclusive running fold of an array, in blocks of blocks so that long arrays stay cheap."""
    fold = lambda xs: F.aggregate(xs, zero, combine)

    def of(v: Column) -> Column:
        if not levels:
            return F.transform(v, lambda _, i: fold(F.slice(v, F.lit(1), i)))
        starts = F.when(F.size(v) > 0, F.sequence(F.lit(1), F.size(v), F.lit(block))).otherwise(F.array().cast("array<int>"))
        ahead = running(F.transform(starts, lambda s: fold(F.slice(v, s, F.lit(block)))), combine, zero, levels - 1, block)
        inside = lambda s, a: bound(F.slice(v, s, F.lit(block)), lambda w: F.transform(w, lambda _, i: combine(a, fold(F.slice(w, F.lit(1), i)))))
        return F.flatten(F.zip_with(starts, ahead, inside))

    return bound(values, of)


def running_total(lengths: Column) -> Column:
    """Exclusive running total of an array of ints."""
    return running(lengths, lambda a, x: a + x, F.lit(0))


def spans(text: Column, pattern: str, groups: dict[str, int]) -> Column:
    """Array of struct(start, end, text, **groups): every leftmost match, in code points, without a second scan by position.

    The gaps that ``split`` leaves and the matches alternate, so positions are running totals of their lengths.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    inner = [F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in groups.values()]
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.char_length(x))
    lengths = F.transform(found, lambda x: F.char_length(x))

    def placed(s: Column) -> Column:
        gap = F.slice(s["gaps"], F.lit(1), F.size(s["lengths"]))
        before = running_total(F.zip_with(gap, s["lengths"], lambda g, n: g + n))
        zipped = F.arrays_zip(s["found"].alias("text"), before.alias("before"), gap.alias("gap"), s["lengths"].alias("n"), *[s[k].alias(k) for k in groups])
        start = lambda z: z["before"] + z["gap"]
        return F.transform(zipped, lambda z: F.struct(start(z).cast("long").alias("start"), (start(z) + z["n"]).cast("long").alias("end"), z["text"].alias("text"), *[z[k].alias(k) for k in groups]))

    made = bound(F.struct(found.alias("found"), gaps.alias("gaps"), lengths.alias("lengths"), *[x.alias(k) for x, k in zip(inner, groups, strict=True)]), placed)
    empty = F.array().cast("array<struct<start:bigint,end:bigint,text:string" + "".join(f",{k}:string" for k in groups) + ">>")
    return F.when(F.regexp_like(text, F.lit(pattern)), made).otherwise(empty)


def best_entropy(candidate: Column, window: int = WINDOW) -> Column:
    """The largest Shannon entropy, in bits, of any window of the candidate, by incremental counts."""
    term = lambda c: F.when(c > 1, c * F.log2(c)).otherwise(F.lit(0.0))
    one = lambda c: F.when(c, F.lit(1.0)).otherwise(F.lit(0.0))

    def scanned(chars: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            enters = F.element_at(chars, i)
            leaves = F.when(i > window, F.element_at(chars, F.greatest(i - window, F.lit(1)))).otherwise(F.lit(""))
            up = F.element_at(state["counts"], enters)
            down = F.coalesce(F.try_element_at(state["counts"], leaves), F.lit(0.0)) + one(leaves == enters)
            total = state["total"] + term(up + 1) - term(up) + term(down - 1) - term(down)
            counts = F.transform_values(state["counts"], lambda k, n: n + one(k == enters) - one(k == leaves))
            full = F.when(i >= window, F.log2(F.lit(float(window))) - total / window).otherwise(F.lit(0.0))
            return F.struct(counts.alias("counts"), total.alias("total"), F.greatest(state["best"], full).alias("best"))

        none = F.map_from_entries(F.transform(F.array_distinct(chars), lambda c: F.struct(c, F.lit(0.0))))
        start = F.struct(none.alias("counts"), F.lit(0.0).alias("total"), F.lit(0.0).alias("best"))
        return F.aggregate(F.sequence(F.lit(1), F.size(chars)), start, step, lambda s: s["best"])

    return bound(F.split(candidate, ""), scanned)


def apart(items: Column) -> Column:
    """The candidates among ``items`` (start, kind_no, end, text; sorted) that overlap no base span.

    A span before a candidate in the order overlaps it if it ends behind its start, one after it if it starts before its end.
    """
    base = lambda x: x["kind_no"] < len(BASE)

    def of(xs: Column) -> Column:
        reached = running(F.transform(xs, lambda x: F.when(base(x), x["end"]).otherwise(F.lit(0).cast("long"))), lambda a, x: F.greatest(a, x), F.lit(0).cast("long"))
        far = F.lit(2**62)
        ahead = F.reverse(running(F.reverse(F.transform(xs, lambda x: F.when(base(x), x["start"]).otherwise(far))), lambda a, x: F.least(a, x), far))
        zipped = F.arrays_zip(xs.alias("x"), reached.alias("reached"), ahead.alias("ahead"))
        return F.transform(F.filter(zipped, lambda z: ~base(z["x"]) & (z["reached"] <= z["x"]["start"]) & (z["ahead"] >= z["x"]["end"])), lambda z: z["x"])

    return bound(items, of)


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc_id, secrets): secrets is an array of struct(start, kind_no, end), in text order."""
    kind = {k: i for i, k in enumerate(KINDS)}
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = lambda found, k: F.transform(found, lambda s: F.struct(s["start"].alias("start"), F.lit(kind[k]).alias("kind_no"), s["end"].alias("end")))
    assign = F.filter(spans(text, BASE["assign"], {"value": 2}), lambda s: F.char_length(s["value"]) >= 6)
    access = F.filter(spans(text, BASE["access"], {}), lambda s: s["end"] - s["start"] >= 20)
    # A run of hexadecimal digits is one match whatever its length, so short runs can stay unmatched.
    hexa = spans(text, BASE["hex"].replace("+", "{24,}"), {})
    found = docs.select(F.col(id_col).alias("doc_id"), F.concat(slim(assign, "assign"), slim(access, "access"), slim(hexa, "hex")).alias("base"), spans(text, CANDIDATE, {}).alias("candidates"))

    def class_threshold(c: Column) -> Column:
        bits = F.lit(None).cast("double")
        for pattern, least in reversed(THRESHOLDS.items()):
            bits = F.when(F.regexp_like(c, F.lit(f"^(?:{pattern})$")), F.lit(least)).otherwise(bits)
        return bits

    def secret(s: Column) -> Column:
        allowed = bound(F.split(s["text"], "[/_=+-]+"), lambda parts: (F.size(parts) > 1) & F.forall(parts, lambda x: F.regexp_like(x, F.lit(PLAIN_PART))))
        allowed |= 2 * F.char_length(F.regexp_replace(s["text"], PLACEHOLDER, "")) < F.char_length(s["text"])
        for pattern in ALLOWED:
            allowed |= F.regexp_like(s["text"], F.lit(f"^(?:{pattern})$"))
        return ~allowed & (best_entropy(s["text"], window) >= class_threshold(s["text"]))

    item = lambda xs, k, t: F.transform(xs, lambda s: F.struct(s["start"].alias("start"), (F.lit(kind[k]) if k else s["kind_no"]).alias("kind_no"), s["end"].alias("end"), t(s).alias("text")))

    def judged(row: Column) -> Column:
        items = F.sort_array(F.concat(item(row["base"], None, lambda _: F.lit("")), item(row["candidates"], "entropy", lambda s: s["text"])))
        extra = F.when(F.size(row["candidates"]) > 0, slim(F.filter(apart(items), secret), "entropy")).otherwise(F.array().cast("array<struct<start:bigint,kind_no:int,end:bigint>>"))
        return F.sort_array(F.concat(row["base"], extra))

    return found.select("doc_id", bound(F.struct("base", "candidates"), judged).alias("secrets"))


def secret_report(docs: DataFrame, **how) -> DataFrame:
    """Counts and span lists of every row; see the module."""
    found = scan(docs, **how)
    names = F.array(*[F.lit(k) for k in KINDS])
    listed = lambda xs: F.array_join(F.transform(xs, lambda s: F.concat_ws(":", F.element_at(names, s["kind_no"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("secrets", lambda s: s["kind_no"] == k)).cast("long")
    base = F.filter("secrets", lambda s: s["kind_no"] < len(BASE))
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("secrets")).alias("spans"))
