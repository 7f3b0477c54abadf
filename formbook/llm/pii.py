"""Personal data: checked patterns, and a character-level bidirectional LSTM with CRF transitions for forms that they miss.

The patterns give the base spans, which stay. The model is trained in numpy from labelled spans: base spans of the documents
in their surroundings, left as they are or written in another form (``rewritten``: brackets for signs, other separators, no plus
sign), beside numbers that are none (``decoy``). Windows of ``WINDOW`` characters that overlap by half are decoded by Viterbi; a span's confidence is the
lowest marginal of its labels. Spans of neighbouring windows that overlap are joined, and of all spans of a document the set
with the highest sum of confidences in which none meets another or a base span is kept. A span that the model adds must
also pass its kind's check (``plausible``): a card number's digits, an address's four parts.

The result is that of all windows of all texts; a span of up to half a window lies whole in one of them. Windows are left out only where the check
that follows shows that they cannot matter: what it passes holds a digit or, as an address, an at in some form, then a word, then a dot in some form (``AT``, from
``plausible`` itself). So the windows that meet one of these are decoded first, and then, until there are no more, those that meet a find: every find that overlaps another,
and so may be joined to it, is there. Joined finds of other windows alone hold neither and would fail their check.
Where Viterbi's sums are highest without a span, the way back and the marginals are left out, since there is none to report.

Scale: one map finds base spans and their surroundings; the model is trained on at most
``SAMPLE`` spans of each kind out of them, a documented bound, has some ten thousand numbers and is sent to the
tasks; a second map reads the texts again and decodes them. Nothing is shuffled or stored but the surroundings. Patterns take time linear in a text.

Edge cases: a null or empty text has no spans and the digest of an empty string; a null doc_id is kept; repeated rows are
documents of their own; an empty table, or one without a base span, trains nothing and adds no spans; extra columns are not read; texts are whole, and
one of any length is decoded window by window. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formbook.llm.common import materialize, ship

#: Fixed values of the contract, in the order in which kinds are listed. Starts where a match cannot begin anew are left out, so no run is read twice.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: What every base span holds one of, by its pattern.
ANCHOR = re.compile(r"[0-9@]")
#: What an address in any form that ``plausible`` passes holds: an at, a word behind it and a dot, each at its place.
AT = re.compile(r"[@＠aA](?:(?<=[@＠])|(?<=[\s\[({<].)[tT](?=[\s\])}>]))(?=[\s\])}>]*+[A-Za-z0-9-]++(?:\s++[dD][oO][tT]\s|\s*+[.\[({<]))")
#: Characters of a window and of its step, spans of each kind that the model is trained on, least confidence of a span that is added.
WINDOW, STEP, SAMPLE, LEAST = 96, 48, 150, 0.8
#: Characters around a span that training sees.
AROUND = 100
LABELS = 1 + 2 * len(KINDS)  # other, then begin and inside of each kind


def luhn(digits: str) -> bool:
    double = "0246813579"
    return sum(int(double[int(c)]) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    upto, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > upto and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            upto = m.end()
        else:
            upto = max(upto, at)
        at = text.find("@", max(upto, at + 1))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the patterns, by kind, then start."""
    if not text or not ANCHOR.search(text):
        return []
    found = [(0, a, b) for a, b in _emails(text)]
    found += [(1, *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split("."))]
    found += [(2, *m.span()) for m in CARD.finditer(text) if 13 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    found += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return found


def plausible(kind: int, text: str) -> bool:
    """Whether a span that the model adds can be what it is taken for."""
    digits = _digits(text)
    if kind == 0:
        plain = re.sub(r"\s*[\[({<]\s*(?:at)\s*[\])}>]\s*|\s+at\s+|\s*[@＠]\s*", "@", text, flags=re.I)
        plain = re.sub(r"\s*[\[({<]\s*(?:dot|\.)\s*[\])}>]\s*|\s+dot\s+|\s*\.\s*", ".", plain, flags=re.I)
        return next(_emails(plain), None) == (0, len(plain))
    if kind == 1:
        parts = re.findall("[0-9]+", text)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15 and re.search(r"[^0-9]", text.strip("+")) is not None


# --- labelled spans for training ----------------------------------------------
def rewritten(kind: int, span: str, rng: random.Random) -> str:
    """``span`` in a form that the patterns do not know."""
    digits = _digits(span)
    if kind == 0:
        at, dot = rng.choice([("(at)", "."), ("[at]", "[dot]"), (" at ", " dot "), (" @ ", "."), ("@", " . "), (" (at) ", " (dot) "), ("{at}", "."), ("＠", ".")])
        local, _, domain = span.partition("@")
        return local + at + domain.replace(".", dot)
    if kind == 1:
        return span.replace(".", rng.choice(["[.]", "(.)", " . ", ". ", "{.}", "[dot]"]))
    if kind == 2:
        return rng.choice([".", "/", "  ", "_", " - "]).join(digits[i : i + 4] for i in range(0, len(digits), 4))
    a, b, c = digits[-10:-7], digits[-7:-4], digits[-4:]
    code = digits[:-10] or "1"
    return rng.choice([f"({a}) {b}-{c}", f"{code}-{a}-{b}-{c}", f"00{code} {a} {b} {c}", f"{a}/{b}-{c}", f"tel:{a}-{b}-{c}"[4:], f"+{code}/{a}/{b}{c}", f"({code}{a}) {b} {c}"])


def decoy(rng: random.Random) -> str:
    """A number or name that is no personal data."""
    n = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    word = lambda k: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(k))
    return rng.choice([
        lambda: f"{rng.randrange(1900, 2100)}-{rng.randrange(1, 13):02}-{rng.randrange(1, 29):02}", lambda: f"{rng.randrange(1, 29)}.{rng.randrange(1, 13)}.{rng.randrange(1900, 2100)}",
        lambda: f"{rng.randrange(24)}:{n(2)}:{n(2)}", lambda: f"v{rng.randrange(9)}.{rng.randrange(30)}.{rng.randrange(30)}", lambda: f"{n(rng.randrange(1, 4))},{n(3)}.{n(2)}",
        lambda: n(rng.randrange(1, 24)), lambda: f"{n(rng.randrange(1, 4))}-{n(rng.randrange(1, 5))}", lambda: "".join(rng.choice("0123456789abcdef") for _ in range(rng.randrange(16, 40))),
        lambda: f"@{word(rng.randrange(3, 10))}", lambda: f"{word(4)} @ {n(2)}", lambda: f"{n(3)}/{n(3)}", lambda: f"{n(1)}.{n(5)}e-{n(2)}", lambda: f"{word(5)}{n(3)}_{word(4)}", lambda: f"({n(2)}) {n(4)}", lambda: f"{n(4)} {n(4)} {n(4)}",
    ])()


def example(pieces: tuple[int, str, str, str], rng: random.Random) -> tuple[str, list[tuple[int, int, int]]]:
    """A training text from (kind, before, span, after), and its spans."""
    kind, before, span, after = pieces
    turn = rng.random()
    middle = span if turn < 0.25 else rewritten(kind, span, rng) if turn < 0.7 else decoy(rng)
    text = before + middle + after
    spans = [(k, a, b) for k, a, b in base_spans(text) if b <= len(before) or a >= len(before) + len(middle) or turn >= 0.7 or turn < 0.25]
    if 0.25 <= turn < 0.7:
        spans.append((kind, len(before), len(before) + len(middle)))
    return text, spans


# --- the model ---------------------------------------------------------------
CODES = 100
DIGITS = ord("0") - 31, ord("9") - 31


@lru_cache(1)
def _code_table() -> np.ndarray:
    """The number of each character: printable ASCII its own, other letters, digits, spaces and signs one each."""
    out = np.full(0x110000, 96, np.uint8)
    out[32:127] = np.arange(1, 96)
    for i in [*range(32), *range(127, len(out))]:
        c = chr(i)
        if c.isalpha():
            out[i] = 97
        elif c.isspace():
            out[i] = 98
    out[ord("＠")] = 99
    return out


def text_codes(text: str) -> np.ndarray:
    return _code_table()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]


def codes(text: str, width: int = WINDOW) -> np.ndarray:
    """A number for each character; 0 fills up."""
    out = text_codes(text[:width])
    return np.pad(out, (0, width - len(out))).astype(np.int64)


def allowed() -> np.ndarray:
    """0 where a label may follow another, else very low: inside only after begin or inside of its kind."""
    out = np.zeros((LABELS, LABELS))
    for k in range(len(KINDS)):
        out[:, 2 + 2 * k] = -1e4
        out[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = 0
    return out


class Tagger:
    """A layer of two LSTMs, one for each direction, an output layer and transitions between labels."""

    def __init__(self, hidden: int = 20, seed: int = 7):
        rng = np.random.default_rng(seed)
        h = self.hidden = hidden
        self.params = {
            "x": rng.normal(size=(2, CODES, 4 * h)).astype(np.float32) * 0.3, "u": rng.normal(size=(2, h, 4 * h)).astype(np.float32) / np.float32(np.sqrt(h)),
            "o": rng.normal(size=(2 * h, LABELS)).astype(np.float32) * 0.1, "b": np.zeros(LABELS, np.float32), "t": np.zeros((LABELS, LABELS), np.float32), "s": np.zeros(LABELS, np.float32),
        }
        self.params["x"][:, :, h : 2 * h] += 1.0  # remember at first

    def steps(self, x: np.ndarray, keep: list | None = None) -> Iterator[np.ndarray]:
        """States (2, rows, hidden) of codes (rows, width), place by place; the second direction goes from the last place to the first."""
        h, (rows, width) = self.hidden, x.shape
        half = np.repeat([0.5, 0.5, 0.5, 1], h).astype(self.params["u"].dtype)  # a gate is 0.5 + 0.5 tanh(z / 2)
        table, u = self.params["x"] * half, self.params["u"] * half
        seen = np.ascontiguousarray(np.stack([x.T, x.T[::-1]], 1), np.intp)
        hid, cell = np.zeros((2, rows, h), u.dtype), np.zeros((2, rows, h), u.dtype)
        z, own, new = np.empty((2, rows, 4 * h), u.dtype), np.empty((2, rows, 4 * h), u.dtype), np.empty((2, rows, h), u.dtype)
        scale, shift = (np.broadcast_to(v, z.shape).copy() for v in (half, (1 - half)))  # whole tables, with which numpy is faster
        for t in range(width):
            np.matmul(hid, u, out=z)
            for way in range(2):
                np.take(table[way], seen[t, way], axis=0, out=own[way], mode="clip")
            z += own
            np.tanh(z, out=z)
            z *= scale
            z += shift
            if keep is not None:
                before, last, cell = cell, hid, cell.copy()
            cell *= z[..., h : 2 * h]
            cell += np.multiply(z[..., :h], z[..., 3 * h :], out=new)
            shown = np.tanh(cell, out=new)
            hid = z[..., 2 * h : 3 * h] * shown
            if keep is not None:
                gates = z.copy()
                slope = np.concatenate([gates[..., : 3 * h] * (1 - gates[..., : 3 * h]), 1 - gates[..., 3 * h :] ** 2], -1)
                keep.append((*(gates[..., k * h : (k + 1) * h] for k in range(4)), before, last, shown.copy(), slope))
            yield hid

    def by_label(self, x: np.ndarray) -> np.ndarray:
        """Emissions (width, labels, rows) of codes (rows, width), each less that of the first label, which changes no likelihood."""
        h, o, b = self.hidden, self.params["o"], self.params["b"]
        first, second = (np.ascontiguousarray((w[:, 1:] - w[:, :1]).T) for w in (o[:h], o[h:]))
        e = np.zeros((x.shape[1], LABELS, len(x)), o.dtype)
        e[:, 1:] = (b[1:] - b[0])[:, None]
        for t, hid in enumerate(self.steps(x)):
            e[t, 1:] += first @ hid[0].T
            e[-1 - t, 1:] += second @ hid[1].T
        return e

    def emissions(self, x: np.ndarray) -> np.ndarray:
        return self.by_label(x).transpose(2, 0, 1).astype(np.float64)

    def chain(self, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For emissions (width, rows, labels): forward and backward sums of the CRF, scaled at each place so that their product is the
        marginal; what a label brings at each place from the one before, scaled alike; the logarithm of the total."""
        t, top = np.exp(self.params["t"] + allowed()), e.max(2, keepdims=True)
        own, width = np.exp(e - top), len(e)
        a, b, scale = np.empty_like(e), np.ones_like(e), np.empty(e.shape[:2])
        for i in range(width):
            a[i] = own[i] * (a[i - 1] @ t if i else np.exp(self.params["s"] + allowed()[0]))
            scale[i] = a[i].sum(1)
            a[i] /= scale[i][:, None]
        own /= scale[:, :, None]
        for i in range(width - 2, -1, -1):
            b[i] = (own[i + 1] * b[i + 1]) @ t.T
        return a, b, own, np.log(scale).sum(0) + top[:, :, 0].sum(0)

    def loss(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Negative log-likelihood of the labels for each row, and its gradients."""
        (rows, width), h = x.shape, self.hidden
        keep: list = []
        s = np.stack(list(self.steps(x, keep)))
        s = np.concatenate([s[:, 0], s[::-1, 1]], -1).transpose(1, 0, 2)
        e = (s @ self.params["o"] + self.params["b"]).astype(np.float64)
        a, b, own, total = self.chain(np.ascontiguousarray(e.transpose(1, 0, 2)))
        t = self.params["t"] + allowed()
        where = np.arange(rows)[:, None], np.arange(width)[None]
        score = e[(*where, y)].sum(1) + (self.params["s"] + allowed()[0])[y[:, 0]] + t[y[:, :-1], y[:, 1:]].sum(1)
        de = (a * b).transpose(1, 0, 2)
        de[(*where, y)] -= 1
        dt = np.exp(t) * (a[:-1].reshape(-1, LABELS).T @ (own * b)[1:].reshape(-1, LABELS))
        np.add.at(dt, (y[:, :-1].ravel(), y[:, 1:].ravel()), -1)
        de = (de / rows).astype(np.float32)
        grads = {"o": s.reshape(-1, 2 * h).T @ de.reshape(-1, LABELS), "b": de.sum((0, 1)), "t": (dt / rows).astype(np.float32), "s": de[:, 0].sum(0)}
        ds = de @ self.params["o"].T
        dout = np.stack([ds[..., :h], ds[:, ::-1, h:]])
        dz = np.empty((width, 2, rows, 4 * h), np.float32)
        dh, dc, du = np.zeros((2, rows, h), np.float32), np.zeros((2, rows, h), np.float32), np.zeros_like(self.params["u"])
        for k in range(width - 1, -1, -1):
            i, f, o, new, before, last, shown, slope = keep[k]
            dh = dh + dout[:, :, k]
            dc = dc + dh * o * (1 - shown * shown)
            d = dz[k]
            d[..., :h], d[..., h : 2 * h], d[..., 2 * h : 3 * h], d[..., 3 * h :] = dc * new, dc * before, dh * shown, dc * i
            d *= slope
            du += np.matmul(last.transpose(0, 2, 1), d)
            dh, dc = np.matmul(d, self.params["u"].transpose(0, 2, 1)), dc * f
        grads["u"], grads["x"] = du, np.empty_like(self.params["x"])
        for way, seen in enumerate((x, x[:, ::-1])):
            is_code = np.zeros((rows * width, CODES), np.float32)
            is_code[np.arange(rows * width), seen.T.ravel()] = 1
            grads["x"][way] = is_code.T @ dz[:, way].reshape(-1, 4 * h)
        return float((total - score).mean()), grads

    def may_hold(self, e: np.ndarray) -> np.ndarray:
        """Of emissions by label the rows whose best labels can be others than none: all of those, and few more.

        Viterbi's sums, each less that of no span, but begin and inside of a kind taken for one with the best transitions of both: no
        row of labels has more.
        """
        t, s = (self.params["t"] - self.params["t"][0, 0]).astype(e.dtype), (self.params["s"] - self.params["s"][0]).astype(e.dtype)
        column = lambda values: np.array(values, e.dtype)[:, None]
        begins = range(1, LABELS, 2)
        enter, other = column([t[0, k] for k in begins]), column([t[1:, k].max() for k in begins])
        stay, leave = column([max(t[k, k + 1], t[k + 1, k + 1]) for k in begins]), column([t[k : k + 2, 0].max() + 1e-2 for k in begins])  # more than single precision loses
        none, within = np.zeros(e.shape[2], e.dtype), e[0, 1::2] + column([s[k] for k in begins])
        for at in range(1, len(e)):
            begun = np.maximum(none + enter, within.max(0) + other) + e[at, 1::2]
            none, within = np.maximum(none, (within + leave).max(0)), np.maximum(begun, within + stay + e[at, 2::2])
        return (none > 0) | ((within + 1e-2).max(0) > 0)

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The most likely labels of each row, and the marginal of each of them."""
        return self.decoded(self.emissions(x))

    def decoded(self, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``decode``, of emissions (rows, width, labels)."""
        a, b, _, _ = self.chain(np.ascontiguousarray(e.transpose(1, 0, 2)))
        t, width = self.params["t"] + allowed(), e.shape[1]
        best, back = e[:, 0] + self.params["s"] + allowed()[0], np.empty(e.shape, np.int8)
        for i in range(1, width):
            step = best[:, :, None] + t
            back[:, i] = step.argmax(1)
            best = e[:, i] + step.max(1)
        labels = np.empty(e.shape[:2], np.int64)
        labels[:, -1] = best.argmax(1)
        for i in range(width - 1, 0, -1):
            labels[:, i - 1] = back[np.arange(len(e)), i, labels[:, i]]
        return labels, np.take_along_axis((a * b).transpose(1, 0, 2), labels[:, :, None], 2)[:, :, 0]


def labels_of(spans: list[tuple[int, int, int]], start: int, width: int) -> np.ndarray:
    y = np.zeros(width, np.int64)
    for kind, a, b in spans:
        a, b = max(a - start, 0), min(b - start, width)
        if a < b:
            y[a], y[a + 1 : b] = 1 + 2 * kind, 2 + 2 * kind
    return y


def train(sample: list[tuple[int, str, str, str]], *, steps: int = 300, rows: int = 48, width: int = WINDOW, hidden: int = 20, seed: int = 11) -> Tagger | None:
    """A tagger from (kind, before, span, after); None without any."""
    if not sample:
        return None
    rng, tagger = random.Random(seed), Tagger(hidden)
    kinds: dict[int, list] = {}
    for s in sorted(sample):
        kinds.setdefault(s[0], []).append(s)
    m1, m2 = ({k: np.zeros_like(v) for k, v in tagger.params.items()} for _ in range(2))
    for step in range(1, steps + 1):
        x, y = [], []
        for _ in range(rows):
            text, spans = example(rng.choice(kinds[rng.choice(sorted(kinds))]), rng)
            start = rng.randrange(max(1, len(text) - width // 2))
            x.append(codes(text[start : start + width], width))
            y.append(labels_of(spans, start, width))
        _, grads = tagger.loss(np.array(x), np.array(y))
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        rate = 0.02 * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, p in tagger.params.items():
            g = grads[k] * min(1.0, 5 / max(norm, 1e-9))
            m1[k] += 0.1 * (g - m1[k])
            m2[k] += 0.01 * (g * g - m2[k])
            p -= (rate * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return tagger


# --- decoding ----------------------------------------------------------------
def stretches(text: str) -> list[tuple[int, str]]:
    """(start, text) of what is decoded: the whole text."""
    return [(0, text)] if text else []


def labelled(labels: np.ndarray, marginal: np.ndarray, start: int) -> list[tuple[int, int, int, float]]:
    """(kind, start, end, confidence) of a window's labels."""
    found = []
    for i in np.flatnonzero(labels % 2 == 1).tolist():
        end = i + 1
        while end < len(labels) and labels[end] == labels[i] + 1:
            end += 1
        found.append((int(labels[i]) // 2, start + i, start + end, float(marginal[i:end].min())))
    return found


def reconciled(base: list[tuple[int, int, int]], found: list[tuple[int, int, int, float]], text_of, least: float = LEAST) -> list[tuple[int, int, int]]:
    """The spans to add: overlapping finds of a kind joined, then of those that meet no base span and pass their check the set with the highest sum."""
    joined: list[list] = []
    for kind in range(len(KINDS)):
        own = sorted(f for f in found if f[0] == kind)
        for k, a, b, p in own:
            if joined and joined[-1][0] == kind and a < joined[-1][2]:
                # Two windows saw the same span: it reaches as far as either says.
                joined[-1][2], joined[-1][3] = max(joined[-1][2], b), max(joined[-1][3], p)
            else:
                joined.append([k, a, b, p])
    taken = sorted((a, b) for _, a, b in base)
    starts = [a for a, _ in taken]
    tops = np.maximum.accumulate([b for _, b in taken]) if taken else np.zeros(0, int)
    free = []
    for k, a, b, p in joined:
        text = text_of(a, b)
        a, b = a + len(text) - len(text.lstrip()), b - len(text) + len(text.rstrip())
        meets = bisect_left(starts, b)
        whole = not any(c.isalnum() for c in text_of(a - 1, a) + text_of(b, b + 1))  # a part of a number or word is none
        if p >= least and a < b and whole and not (meets and tops[meets - 1] > a) and plausible(k, text.strip()):
            free.append((b, a, k, p))
    free.sort()
    ends = [f[0] for f in free]
    best, choice = [0.0], []
    for i, (_, a, _, p) in enumerate(free):
        before = int(np.searchsorted(ends[:i], a, "right"))
        take = best[before] + p
        choice.append((take > best[i], before))
        best.append(max(best[i], take))
    out, i = [], len(free)
    while i:
        take, before = choice[i - 1]
        if take:
            b, a, k, _ = free[i - 1]
            out.append((k, a, b))
            i = before
        else:
            i -= 1
    return out


def _count(text: str) -> int:
    return max(1, -(-(len(text) - STEP) // STEP))


def _halves(text: str, first: int, own: int) -> np.ndarray:
    """Codes of the half windows that ``own`` windows from number ``first`` on consist of; the last places may be empty."""
    piece = text_codes(text[first * STEP : (first + own + 1) * STEP])
    return np.pad(piece, (0, (own + 1) * STEP - len(piece))).reshape(-1, STEP)


def anchored(text: str) -> np.ndarray:
    """For each window whether it meets a digit or an at of any form with a dot of any form behind the next word."""
    count = _count(text)
    half = np.zeros(count + 1, bool)
    half[[m.start() // STEP for m in AT.finditer(text)]] = True
    for first in range(0, count, 1000):
        codes = _halves(text, first, min(1000, count - first))
        half[first : first + len(codes)] |= ((codes >= DIGITS[0]) & (codes <= DIGITS[1])).any(1)
    return half[:-1] | half[1:]


def _windows(text: str, taken: np.ndarray) -> Iterator[tuple[list[int], np.ndarray]]:
    """Numbers and codes of the windows that are ``taken``, of up to a thousand each."""
    for first in range(0, len(taken), 1000):
        some = np.flatnonzero(taken[first : first + 1000])
        if len(some):
            halves = _halves(text, first, min(1000, len(taken) - first))
            yield (first + some).tolist(), np.hstack([halves[some], halves[some + 1]])


def decode_stretches(tagger: Tagger, rows: list[list[tuple[int, str]]], most: int = 512) -> list[list[tuple[int, int, int, float]]]:
    """What the tagger finds in the stretches of each document, but for finds that no check can pass (see above)."""
    found: list[list] = [[] for _ in rows]
    parts = [(i, a, text) for i, own in enumerate(rows) for a, text in own]
    turn = [anchored(text) for _, _, text in parts]
    done = [np.zeros(len(t), bool) for t in turn]
    where: list[tuple[int, int]] = []
    waiting: list[np.ndarray] = []

    def run(upto: int) -> None:
        """Windows that wait, ``most`` at a time, while there are ``upto`` or more."""
        nonlocal where, waiting
        every = np.concatenate(waiting)
        at = 0
        while len(every) - at >= max(upto, 1):
            e = tagger.by_label(every[at : at + most])
            some = np.flatnonzero(tagger.may_hold(e))
            if len(some):
                labels, marginal = tagger.decoded(np.ascontiguousarray(e[:, :, some].transpose(2, 0, 1), np.float64))
                for j in np.flatnonzero((labels % 2 == 1).any(1)).tolist():
                    (n, w), size = where[at + some[j]], int(np.count_nonzero(every[at + some[j]]))  # no character has number 0
                    i, a, _ = parts[n]
                    own = labelled(labels[j, :size], marginal[j, :size], a + w * STEP)
                    found[i] += own
                    for _, low, high, _ in own:  # the next turn decodes what may be joined to it
                        turn[n][max(0, (low - a) // STEP - 1) : (high - 1 - a) // STEP + 1] = True
            at += most
        where, waiting = where[at:], [every[at:]]

    while True:
        left = [(n, turn[n] & ~done[n]) for n in range(len(parts))]
        left = [(n, taken) for n, taken in left if taken.any()]
        if not left:
            return found
        for n, taken in left:
            done[n] |= taken
            for numbers, own in _windows(parts[n][2], taken):
                where += [(n, w) for w in numbers]
                waiting.append(own)
                if len(where) >= 4 * most:
                    run(most)
        if where:
            run(1)


REPORT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def _surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 500):
            rows = []
            for t in whole.slice(at, 500).column(0).to_pylist():
                for k, a, b in base_spans(t):
                    first, last = max(0, (a // STEP - 1) * STEP, a - AROUND), min(((b - 1) // STEP + 2) * STEP, b + AROUND)  # the windows that meet the span
                    if b - a <= STEP:
                        rows.append((k, t[first:a], t[a:b], t[b:last]))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *[pa.array(c, pa.string()) for c in cols[1:]]], ["kind", "before", "span", "after"])


def fitted(texts: DataFrame, sample: int = SAMPLE, **options) -> Tagger | None:
    """A tagger from at most ``sample`` base spans of each kind in ``texts`` (text), chosen by a hash."""
    around = materialize(texts.where("text is not null").mapInArrow(_surroundings, "kind int, before string, span string, after string"), "labelled")
    order = F.xxhash64("before", "span", "after")
    some = reduce(DataFrame.unionByName, [around.where(F.col("kind") == k).orderBy(order, "before", "span", "after").limit(sample) for k in range(len(KINDS))])
    return train([(r.kind, r.before, r.span, r.after) for r in some.collect()], **options)


def shown(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def _reported(tagger: Tagger | None):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                texts = [t or "" for t in batch.column(1).to_pylist()]
                found = decode_stretches(tagger, [stretches(t) for t in texts]) if tagger else [[] for _ in texts]
                rows = []
                for doc, text, finds in zip(batch.column(0).to_pylist(), texts, found, strict=True):
                    base = base_spans(text)
                    more = reconciled(base, finds, lambda a, b, text=text: text[max(0, a) : b]) if finds else []
                    counts = [sum(k == kind for k, _, _ in base) for kind in range(len(KINDS))]
                    rows.append((doc, *counts, hashlib.sha256(shown(base).encode()).hexdigest(), shown(base + more), len(more)))
                if rows:
                    cols = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols[:5]], pa.array(cols[5], pa.string()), pa.array(cols[6], pa.string()), pa.array(cols[7], pa.int64())], [c.split()[0] for c in REPORT.split(", ")])

    return of


def pii_report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) for every document."""
    ship(docs.sparkSession)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(_reported(fitted(slim.select("text"), sample)), REPORT)
