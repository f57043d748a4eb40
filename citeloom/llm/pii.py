"""Personal data: fixed patterns, and a character-level bidirectional LSTM with CRF transitions.

The tagger is trained in numpy on labelled spans: windows of sampled texts, with the spans that the patterns find in
them and with drawn ones put in, among them forms that the patterns miss (spaced or bracketed addresses, numbers with
other separators), and with look-alikes that are no personal data. Every kind holds a digit or an @ sign; so the
windows around these signs, which overlap, cover all that there is to find in a whole text. Windows are decoded one by
one, and the spans of all windows of a text are reconciled at once: of spans that overlap, the set with the largest total
score stays. A span that the tagger adds must still hold what its kind must hold (a check sum, four bytes, ...).
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.common import map_columns
from citeloom.llm.tagger import Tagger

KINDS = ("email", "ip", "card", "phone")
#: Fixed patterns (given values).
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),  # starts at a number's first digit anyway
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
SIGN = re.compile("[0-9@]")
#: The two sides of an address's @ sign in the fixed pattern.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
HOST = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")

WINDOW = 96
STRIDE = 48
MARGIN = 24
HIDDEN = 24
#: Bounds of the training sample: texts, their characters, and windows drawn from them.
SAMPLE_ROWS, SAMPLE_CHARS, TRAIN_WINDOWS, EPOCHS = 400, 4000, 1500, 12
#: A span needs this mean lead over "no personal data" per character.
LEAST_LEAD = 1.0

#: Character classes: each mark of these has its own, then digits, small, capital and other letters, blanks, the rest.
MARKS = "@._%+-()[]/:,;=#\"'"
N_SYMBOLS = len(MARKS) + 8


def _symbol_table() -> np.ndarray:
    table = np.full(128, len(MARKS) + 1)
    for c in range(128):
        ch = chr(c)
        if ch.isdigit():
            table[c] = len(MARKS) + 2
        elif ch.islower():
            table[c] = len(MARKS) + 3
        elif ch.isupper():
            table[c] = len(MARKS) + 4
        elif ch == "\n":
            table[c] = len(MARKS) + 5
        elif ch.isspace():
            table[c] = len(MARKS) + 6
    for i, ch in enumerate(MARKS):
        table[ord(ch)] = i + 1
    return table


SYMBOLS = _symbol_table()


def symbols(text: str) -> np.ndarray:
    """Character classes of a text; 0 is padding."""
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    return np.where(codes < 128, SYMBOLS[np.minimum(codes, 127)], len(MARKS) + 7)


def _digits(found: str) -> str:
    return re.sub("[^0-9]", "", found)


def _luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = int(ch) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _bytes(numbers: list[str]) -> bool:
    return len(numbers) == 4 and all(len(n.lstrip("0")) <= 3 and int(n.lstrip("0") or "0") <= 255 for n in numbers)


CHECKS: dict[str, Callable[[str], bool]] = {
    "email": lambda m: True,
    "ip": lambda m: _bytes(m.split(".")),
    "card": lambda m: 12 <= len(d := _digits(m)) <= 19 and _luhn(d),
    "phone": lambda m: 9 <= len(_digits(m)) <= 15,
}


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of the fixed address pattern, found from each @ sign to both sides, so that a long word costs one look."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        before = text[free:at]
        start = free + len(before.rstrip(LOCAL))
        host = HOST.match(text, at + 1) if start < at else None
        if host:
            found.append((start, host.end()))
        free = host.end() if host else at + 1
        at = text.find("@", free)
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns' matches that pass their kind's check."""
    if not SIGN.search(text):
        return []
    found = [(start, KINDS.index("email"), end) for start, end in emails(text)]
    for k, kind in enumerate(KINDS):
        if kind != "email":
            check = CHECKS[kind]
            found += [(m.start(), k, m.end()) for m in PATTERNS[kind].finditer(text) if check(m[0])]
    return found


def _plausible(kind: str, found: str) -> bool:
    """What a span of the tagger must hold, whatever its separators."""
    if kind == "email":
        return bool(re.search(r"[A-Za-z0-9][ (\[]*@[ )\]]*[A-Za-z0-9]", found))
    if kind == "ip":
        numbers = re.findall("[0-9]+", found)
        return all(len(n) <= 3 for n in numbers) and _bytes(numbers)
    if kind == "card":
        return 12 <= len(d := _digits(found)) <= 19 and _luhn(d)
    return 9 <= len(_digits(found)) <= 15


class _Drawn:
    """Draws entities and look-alikes for training."""

    def __init__(self, seed: int):
        self.rng = np.random.default_rng(seed)

    def pick(self, options):
        return options[int(self.rng.integers(len(options)))]

    def digits(self, n: int) -> str:
        return "".join(map(str, self.rng.integers(0, 10, n)))

    def word(self, low: int = 2, high: int = 9) -> str:
        return "".join(chr(97 + int(c)) for c in self.rng.integers(0, 26, int(self.rng.integers(low, high))))

    def email(self) -> str:
        local = self.word() + self.pick(["", ".", "_", "-", "+"]) + self.pick([self.word(), self.digits(2)])
        at = self.pick(["@", "@", "@", " @ ", "(@)", "[@]"])
        return local + at + ".".join(self.word() for _ in range(int(self.rng.integers(1, 4))))

    def ip(self) -> str:
        return self.pick([".", ".", ".", "[.]", " . ", ","]).join(str(int(n)) for n in self.rng.integers(0, 256, 4))

    def card(self) -> str:
        gap = self.pick(["", "", " ", "-", ".", "/", "  "])
        return gap.join(self.digits(4) for _ in range(4)) if self.rng.random() < 0.8 else gap.join([self.digits(4), self.digits(6), self.digits(5)])

    def phone(self) -> str:
        plus, a, b, c = self.pick(["+", "+", "", "00"]), self.digits(int(self.rng.integers(1, 3))), self.digits(3), self.digits(4)
        area, gap = self.digits(3), self.pick([" ", "-", "."])
        return self.pick([f"{plus}{a} ({area}) {b}-{c}", f"{plus}{a}{gap}{area}{gap}{b}{gap}{c}", f"({area}) {b}-{c}", f"{area}-{b}-{c}"])

    def lookalike(self) -> str:
        d = self.digits
        return self.pick([
            f"{d(4)}-{d(2)}-{d(2)}", f"{d(1)}.{d(1)}", f"{d(1)}.{d(2)}.{d(1)}", f"{d(2)}:{d(2)}", f"{d(3)}.{d(2)}", d(int(self.rng.integers(1, 9))),
            hashlib.sha1(d(6).encode()).hexdigest(), f"{d(1)},{d(3)},{d(3)}", f"@{self.word()}", f"v{d(1)}.{d(1)}", f"#{d(5)}", f"{d(2)}%", f"({d(4)})",
        ])


def training_windows(texts: list[str], windows: int = TRAIN_WINDOWS, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and tags (0: none, 2k+1 and 2k+2: first and other characters of kind k) of drawn windows."""
    drawn = _Drawn(seed)
    usable = [t for t in texts if t.strip()] or ["no text"]
    x, y = np.zeros((windows, WINDOW), np.int64), np.zeros((windows, WINDOW), np.int64)
    for row in range(windows):
        text = drawn.pick(usable)
        at = int(drawn.rng.integers(0, max(1, len(text) - WINDOW)))
        snippet = text[at : at + WINDOW]
        spans = [] if row % 6 == 0 else None
        for _ in range(int(drawn.rng.integers(0, 3)) if spans is not None else 1):
            snippet, _ = _put(snippet, drawn.lookalike(), drawn)
        spans = [(s, k, e) for s, k, e in base_spans(snippet)]
        if row % 6:
            kind = int(drawn.rng.integers(len(KINDS)))
            entity = getattr(drawn, KINDS[kind])()
            snippet, start = _put(snippet, entity, drawn)
            spans = [s for s in base_spans(snippet) if s[2] <= start or s[0] >= start + len(entity)] + [(start, kind, start + len(entity))]
        snippet = snippet[:WINDOW]
        x[row, : len(snippet)] = symbols(snippet)
        for start, kind, end in sorted(spans):
            if end <= WINDOW:
                y[row, start:end] = 2 * kind + 2
                y[row, start] = 2 * kind + 1
    return x, y


def _put(snippet: str, piece: str, drawn: _Drawn) -> tuple[str, int]:
    """``piece`` in place of what stands between two blanks or at an end."""
    gaps = [i for i, c in enumerate(snippet[: max(1, WINDOW - len(piece) - 2)]) if c == " "] or [0]
    at = drawn.pick(gaps)
    lead = " " if at or drawn.rng.random() < 0.5 else ""
    return f"{snippet[:at]}{lead}{piece}{drawn.pick([' ', ' ', '. ', ', ', chr(10)])}{snippet[at:].lstrip(' ')}", at + len(lead)


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Tagger:
    """A tagger trained on windows of a hash sample of some ``sample_rows`` texts of ``docs``."""
    share = max(1, -(-docs.count() // sample_rows))
    picked = docs.where(F.col("text").isNotNull()).where(F.pmod(F.xxhash64("doc_id"), F.lit(share)) == 0)
    rows = picked.select("doc_id", F.substring("text", 1, SAMPLE_CHARS).alias("text")).orderBy("doc_id", "text").limit(2 * sample_rows).collect()
    tagger = Tagger.new(N_SYMBOLS, HIDDEN, 1 + 2 * len(KINDS), seed=1)
    tagger.train(*training_windows([r["text"] for r in rows]), epochs=EPOCHS)
    return tagger


def windows_of(text: str) -> list[int]:
    """Starts of overlapping windows that cover each digit and @ sign with MARGIN characters around it."""
    starts: list[int] = []
    covered = -1
    for m in SIGN.finditer(text):
        if m.start() + MARGIN > covered and m.start() + 1 > covered - MARGIN:
            start = max(starts[-1] + STRIDE if starts else 0, m.start() - 2 * MARGIN)
            if start < len(text):
                starts.append(start)
                covered = start + WINDOW
    return starts


def reconcile(spans: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int]]:
    """Of (start, kind, end, score) the set of non-overlapping spans with the largest total score, as (start, kind, end)."""
    best: dict[tuple[int, int, int], float] = {}
    for start, kind, end, score in spans:
        best[start, kind, end] = max(score, best.get((start, kind, end), score))
    order = sorted(best, key=lambda s: (s[2], s))
    ends = [s[2] for s in order]
    totals, chosen = [0.0], []
    for i, span in enumerate(order):
        before = bisect.bisect_right(ends, span[0], 0, i)
        with_it = totals[before] + best[span]
        chosen.append((with_it > totals[i], before))
        totals.append(max(totals[i], with_it))
    out, i = [], len(order)
    while i:
        take, before = chosen[i - 1]
        if take:
            out.append(order[i - 1])
        i = before if take else i - 1
    return sorted(out)


def tagged_spans(tagger: Tagger, texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """(start, kind, end) of the spans that the tagger finds in each text, reconciled over all windows of the text.

    A span cut at a window's edge is looked at again in a window around it; one that is longer than a window is none.
    """
    found: list[list[tuple[int, int, int, float]]] = [[] for _ in texts]
    cut = _decode(tagger, texts, [(i, start) for i, text in enumerate(texts) for start in windows_of(text)], found)
    _decode(tagger, texts, sorted({(i, max(0, (start + end - WINDOW) // 2)) for i, start, end in cut}), found)
    return [reconcile(spans) for spans in found]


def _decode(tagger: Tagger, texts: list[str], places: list[tuple[int, int]], found: list[list[tuple[int, int, int, float]]]) -> list[tuple[int, int, int]]:
    """Adds the whole spans of the windows at ``places`` (text, start) to ``found`` and returns the cut ones as (text, start, end)."""
    cut = []
    for at in range(0, len(places), 512):
        part = places[at : at + 512]
        x = np.zeros((len(part), WINDOW), np.int64)
        for row, (i, start) in enumerate(part):
            own = symbols(texts[i][start : start + WINDOW])
            x[row, : len(own)] = own
        tags, lead = tagger.decode(x)
        for row in np.flatnonzero((tags > 0).any(axis=1)):
            i, start = part[row]
            length = min(WINDOW, len(texts[i]) - start)
            own, pos = tags[row, :length], 0
            while pos < length:
                if own[pos] == 0:
                    pos += 1
                    continue
                kind, end = (int(own[pos]) - 1) // 2, pos + 1
                while end < length and own[end] == 2 * kind + 2:
                    end += 1
                score = float(lead[row, pos:end].sum())
                if (pos == 0 and start > 0) or (end == length and start + length < len(texts[i])):
                    cut.append((i, start + pos, start + end))
                elif score >= LEAST_LEAD * (end - pos):
                    found[i].append((start + pos, kind, start + end, score))
                pos = end
    return cut


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{start}:{end}" for start, k, end in sorted(spans))


def scan(docs: DataFrame, tagger: Tagger, id_col: str = "doc_id") -> DataFrame:
    """(id_col, n_email, n_ip, n_card, n_phone, n_added, base_sha256, spans) of each row of ``docs``.

    Spans are kind:start:end in code points of the whole text, by start, then kind. Counts and digest are of the fixed
    patterns; ``spans`` holds theirs and those that the tagger adds where no pattern matched. Null and empty texts have
    none. Repeated rows are scanned alike; other columns are not looked at; an empty table gives an empty table.
    """
    sent = docs.sparkSession.sparkContext.broadcast(tagger)

    def run(batch: pa.RecordBatch) -> dict:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        base = [base_spans(t) for t in texts]
        tagged = tagged_spans(sent.value, texts)
        out: dict = {"id": batch.column(0), "base_sha256": [], "spans": [], "n_added": []} | {f"n_{k}": [] for k in KINDS}
        for text, own, more in zip(texts, base, tagged, strict=True):
            new = [
                s for s in more
                if all(s[2] <= b[0] or s[0] >= b[2] for b in own) and _plausible(KINDS[s[1]], text[s[0] : s[2]])
            ]
            for k, kind in enumerate(KINDS):
                out[f"n_{kind}"].append(sum(b[1] == k for b in own))
            out["n_added"].append(len(new))
            out["base_sha256"].append(hashlib.sha256(_listed(own).encode()).hexdigest())
            out["spans"].append(_listed(own + new))
        return out

    counts = ", ".join(f"n_{k} long" for k in (*KINDS, "added"))
    rows = docs.select(F.col(id_col).alias("id"), "text")
    return map_columns(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, {counts}, base_sha256 string, spans string").withColumnRenamed("id", id_col)
