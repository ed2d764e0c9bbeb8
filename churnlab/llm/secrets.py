"""Secret scans: base patterns, and formats learned by grammar inference."""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, deque
from dataclasses import dataclass, replace
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlab.llm.common import chunks, picked, written

# The base patterns. A match of fewer characters (of its value,
# group 2, or of all of it) is dropped.
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
BASE_KINDS = ("assign", "access", "hex")
# A run of fewer hex digits is no match whatever stands around it.
LONG_HEX = re.compile(r"[0-9a-f]{24,}")

#: The kind of spans that are found by their format alone.
FORMAT = "format"
#: Shorter words than this are no candidates.
LEAST_CANDIDATE = 12
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_.=-]{{{LEAST_CANDIDATE},}}")
WORD = re.compile(r"[A-Za-z0-9+/_.=-]+")
#: Credentials of each kind, and WORDS_EACH times as many long words and short ones,
#: from which formats are learned; they come from the first documents by a hash of
#: the id. Of longer values the first FIT_LENGTH characters are learned, and no end.
FIT_DOCS, FIT_VALUES, WORDS_EACH, FIT_LENGTH = 20_000, 1000, 4, 80
#: Confidence parameter of the state merging (smaller merges more).
ALPHA = 0.05
#: A candidate is reported from a likelihood ratio per character (natural logarithm)
#: against ordinary words on. That is set on values held out from the fit (see
#: ``calibrated``) and is at least LEAST_RATIO, which holds where either side has too few.
LEAST_RATIO, HELD_OUT = 0.5, 10
#: What a false alarm costs there, in missed credentials (as shares of the two sides).
FALSE_ALARM = 3
#: A start of a value of at most so many characters is kept letter by letter if this
#: share of a kind's examples, and so many at least, begin with it.
LITERAL, LITERAL_SHARE, LITERAL_COUNT = 8, 0.05, 5


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, by start, then kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    found += [(m.start(), 2, m.end()) for m in LONG_HEX.finditer(text)]
    return [(BASE_KINDS[kind], start, end) for start, kind, end in sorted(found)]


# Symbols of a value: each character in its place as a small or capital vowel or
# consonant, a digit, or itself.
OTHERS = "+/_.=-"
CLASSES = {"v": "aeiouy", "c": "bcdfghjklmnpqrstvwxz", "V": "AEIOUY", "C": "BCDFGHJKLMNPQRSTVWXZ", "9": "0123456789"}
SYMBOLS = "".join(CLASSES) + OTHERS
CLASS_OF = {c: name for name, characters in CLASSES.items() for c in characters} | {c: c for c in OTHERS}
TO_SYMBOLS = str.maketrans({c: name for c, name in CLASS_OF.items() if c not in OTHERS})
SEPARATOR = re.compile(r"([+/_.=-])")


def symbols_of(value: str) -> str:
    return value.translate(TO_SYMBOLS)


def parts_of(value: str) -> tuple[list[str], str]:
    """The symbols of a word's parts between separators, those of parts in capitals or with one
    first as if they were small; and the separators."""
    pieces = SEPARATOR.split(value)
    parts = [w.lower() if w.isupper() or w[1:].islower() else w for w in pieces[::2]]
    return [symbols_of(w) for w in parts], "".join(pieces[1::2])


def literal(start: str) -> str:
    """Symbols that stand for just these characters."""
    return "".join(chr(0xE000 + ord(c)) for c in start)


def literal_starts(values: list[str]) -> list[str]:
    """Starts of two characters and more that many of the values share, longest first."""
    counts = Counter(v[:n] for v in values for n in range(2, min(LITERAL, len(v)) + 1))
    least = max(LITERAL_COUNT, LITERAL_SHARE * len(values))
    return sorted((s for s, n in counts.items() if n >= least), key=lambda s: (-len(s), s))


def form(value: str, starts: list[str]) -> tuple[str, int]:
    """The value's symbols, its longest known start as literal ones, and that start's length."""
    start = next((s for s in starts if value.startswith(s)), "")
    return literal(start) + symbols_of(value)[len(start) :], len(start)


def literal_gain(start: str) -> float:
    """What literal symbols say beyond the classes of their characters."""
    return sum(math.log(len(CLASSES.get(CLASS_OF[c], c))) for c in start)


class Automaton:
    """A probabilistic automaton, learned by merging states of a prefix tree.

    States of the tree that is made of all examples are merged if their
    frequencies of ending and of going on with each symbol, and those of the
    states that follow, differ by no more than chance allows (the Hoeffding
    bound; ALERGIA, Carrasco and Oncina, 1994). Of examples over ``longest`` symbols
    the rest is not learned, nor an end.
    """

    def __init__(self, examples: list[str], alpha: float = ALPHA, longest: int = FIT_LENGTH):
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        self.to: list[dict[str, int]] = [{}]
        self.went: list[Counter] = [Counter()]
        self.ended: list[int] = [0]
        for example in examples:
            at = 0
            for symbol in example[:longest]:
                self.went[at][symbol] += 1
                if symbol not in self.to[at]:
                    self.to[at][symbol] = len(self.to)
                    self.to.append({})
                    self.went.append(Counter())
                    self.ended.append(0)
                at = self.to[at][symbol]
            self.ended[at] += len(example) <= longest
        self._merge_states()
        self._score_table()

    def _total(self, state: int) -> int:
        return self.ended[state] + self.went[state].total()

    def _alike(self, p: int, q: int) -> bool:
        pending = [(p, q)]
        while pending:
            p, q = pending.pop()
            n, m = self._total(p), self._total(q)
            if not n or not m:
                continue
            limit = self.bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if abs(self.ended[p] / n - self.ended[q] / m) > limit:
                return False
            for symbol in self.went[p].keys() | self.went[q].keys():
                if abs(self.went[p][symbol] / n - self.went[q][symbol] / m) > limit:
                    return False
                if symbol in self.to[p] and symbol in self.to[q]:
                    pending.append((self.to[p][symbol], self.to[q][symbol]))
        return True

    def _fold(self, p: int, q: int) -> None:
        """Put the tree below q onto p."""
        pending = [(p, q)]
        while pending:
            p, q = pending.pop()
            self.ended[p] += self.ended[q]
            self.went[p] += self.went[q]
            for symbol, below in self.to[q].items():
                if symbol in self.to[p]:
                    pending.append((self.to[p][symbol], below))
                else:
                    self.to[p][symbol] = below

    def _merge_states(self) -> None:
        final = [0]
        seen = {0}
        fringe = deque((0, symbol) for symbol in sorted(self.to[0]))
        while fringe:
            parent, symbol = fringe.popleft()
            state = self.to[parent][symbol]
            if state in seen:
                continue
            for known in final:
                if self._alike(known, state):
                    self.to[parent][symbol] = known
                    self._fold(known, state)
                    break
            else:
                final.append(state)
                seen.add(state)
            # A fold may have given new successors to any of the final states.
            fringe = deque((s, x) for s in final for x in sorted(self.to[s]) if self.to[s][x] not in seen)
        number = {state: i for i, state in enumerate(final)}
        self.to = [{x: number[t] for x, t in self.to[s].items()} for s in final]
        self.went, self.ended = [self.went[s] for s in final], [self.ended[s] for s in final]

    def _score_table(self) -> None:
        symbols = SYMBOLS + "".join(sorted({x for went in self.went for x in went} - set(SYMBOLS)))
        options = len(symbols) + 1
        self.other = math.log(1 / options)
        self.logs = []
        for state in range(len(self.to)):
            whole = self._total(state) + 0.1 * options
            self.logs.append({x: math.log((self.went[state][x] + 0.1) / whole) for x in symbols} | {"": math.log((self.ended[state] + 0.1) / whole)})

    def log_likelihood(self, example: str) -> float:
        """Natural logarithm of the probability; beyond known states, all symbols are as likely."""
        state, total = 0, 0.0
        for i, symbol in enumerate(example):
            total += self.logs[state].get(symbol, self.other)
            state = self.to[state].get(symbol)
            if state is None:
                return total + (len(example) - i) * self.other
        return total + self.logs[state][""]


class Ordinary:
    """Ordinary words: parts from an automaton, and after each a separator or the end."""

    def __init__(self, words: list[str]):
        cut = [parts_of(w) for w in words]
        self.automaton = Automaton([part for parts, _ in cut for part in parts])
        after = Counter(x for _, separators in cut for x in (*separators, ""))
        whole = after.total() + len(OTHERS) + 1
        self.after = {x: math.log((after[x] + 1) / whole) for x in (*OTHERS, "")}

    def log_likelihood(self, value: str) -> float:
        parts, separators = parts_of(value)
        return sum(map(self.automaton.log_likelihood, parts)) + sum(self.after[x] for x in separators) + self.after[""]


@dataclass(frozen=True)
class Formats:
    secret: dict[str, Automaton]
    ordinary: Ordinary
    starts: dict[str, list[str]]
    least: float = LEAST_RATIO

    def ratio(self, value: str) -> float:
        """The best likelihood ratio per character of any credential format against ordinary words."""
        if not self.secret or not value:
            return 0.0
        symbols = symbols_of(value)
        best = max(a.log_likelihood(symbols) for a in self.secret.values())
        for kind, automaton in self.secret.items():
            own, n = form(value, self.starts.get(kind, []))
            if n:
                best = max(best, automaton.log_likelihood(own) + literal_gain(value[:n]))
        return (best - self.ordinary.log_likelihood(value)) / len(value)


def calibrated(credentials: list[float], words: list[float]) -> float:
    """The ratio with the least cost on held-out credentials and words: the share of
    credentials below it, and FALSE_ALARM times that of words from it on; the middle
    of the best gap. Words may hold credentials that bear no label, so none has to
    be below."""
    if min(len(credentials), len(words)) < HELD_OUT:
        return LEAST_RATIO
    at = sorted({*credentials, *words})
    low, high = sorted(credentials), sorted(words)

    def cost(t: float) -> float:
        return bisect_left(low, t) / len(low) + FALSE_ALARM * (1 - bisect_left(high, t) / len(high))

    gaps = [((a + b) / 2, b - a) for a, b in zip(at, at[1:])] + [(at[0], 0.0)]
    return max(LEAST_RATIO, min(gaps, key=lambda g: (cost(g[0]), -g[1], g[0]))[0])


class Covered:
    """Spans by start; asked about words from left to right, each span is looked at once."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.spans, self.at, self.end = spans, 0, -1

    def _reach(self, before: int) -> int:
        """The furthest end of the spans that start before a place."""
        while self.at < len(self.spans) and self.spans[self.at][0] < before:
            self.end = max(self.end, self.spans[self.at][1])
            self.at += 1
        return self.end

    def touch(self, start: int, end: int) -> bool:
        return self._reach(end) > start

    def hold(self, start: int, end: int) -> bool:
        return self._reach(start + 1) >= end


def _examples(batches):
    """(kind, value) of credentials that the base patterns label, and of ordinary
    words, long ones of kind "" and shorter ones of kind "word"."""
    for part in chunks(batches, 1024):
        found = set()
        for text in part.column("text").to_pylist():
            base = base_spans(text or "")
            for kind, start, end in base:
                value = text[start:end]
                if kind == "assign":
                    value = ASSIGN.match(value).group(2)
                found.add((kind, value[: FIT_LENGTH + 1]))
            covered = Covered([(start, end) for _, start, end in base])
            for m in WORD.finditer(text or ""):
                if not covered.touch(m.start(), m.end()):
                    found.add(("" if m.end() - m.start() >= LEAST_CANDIDATE else "word", m.group()[: FIT_LENGTH + 1]))
        kinds, values = zip(*found) if found else ((), ())
        yield pa.RecordBatch.from_pydict({"kind": pa.array(kinds, pa.string()), "value": pa.array(values, pa.string())})


def learn_formats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_docs: int = FIT_DOCS, fit_values: int = FIT_VALUES) -> Formats:
    """Learn an automaton for each kind of credential, and one for the parts of ordinary words.

    The examples are labelled by the base patterns in at most ``fit_docs``
    documents; of each kind at most ``fit_values`` different ones, the first by
    hash, come to the driver, and WORDS_EACH times as many ordinary words of
    LEAST_CANDIDATE characters and more, and of fewer. Half of the credentials and
    long words (by a checksum) are held out to set the ratio from which a word is reported.
    """
    rows = picked(docs, id=id_col, text=text_col).withColumn("text", F.col("text").cast("string"))
    ids = rows.select("id").filter("id is not null").distinct().orderBy(F.xxhash64("id"), "id").limit(fit_docs)
    found = rows.join(F.broadcast(ids), "id", "left_semi").select("text").mapInArrow(_examples, "kind string, value string")
    found = written(found.distinct(), "secret-examples")
    fitted: dict[str, list[str]] = {}
    held: dict[str, list[str]] = {}
    for kind in ("", "word", *BASE_KINDS):
        first = found.filter(F.col("kind") == kind).orderBy(F.xxhash64("value"), "value")
        values = [r["value"] for r in first.select("value").limit(fit_values * (1 if kind in BASE_KINDS else WORDS_EACH)).collect()]
        held[kind] = [v for v in values if kind != "word" and crc32(v.encode()) % 2]
        fitted[kind] = [v for v in values if kind == "word" or not crc32(v.encode()) % 2]
        if len(held[kind]) < HELD_OUT:  # too few to tell anything: all go into the fit
            fitted[kind] = values
    starts = {kind: literal_starts(fitted[kind]) for kind in BASE_KINDS}
    secret = {kind: Automaton([form(v, starts[kind])[0] for v in fitted[kind]]) for kind in BASE_KINDS if fitted[kind]}
    formats = Formats(secret, Ordinary(fitted[""] + fitted["word"]), starts)
    credentials = [formats.ratio(v) for kind in BASE_KINDS for v in held[kind]]
    return replace(formats, least=calibrated(credentials, [formats.ratio(v) for v in held[""]]))


def all_spans(text: str, formats: Formats) -> list[tuple[str, int, int, float]]:
    """Base spans, and candidates not inside of one with the format of a credential: (kind, start, end, ratio)."""
    base = base_spans(text)
    found = []
    for kind, start, end in base:
        value = text[start:end]
        found.append((start, BASE_KINDS.index(kind), end, kind, formats.ratio(ASSIGN.match(value).group(2) if kind == "assign" else value)))
    covered = Covered([(start, end) for _, start, end in base])
    for m in CANDIDATE.finditer(text):
        if covered.hold(m.start(), m.end()):
            continue
        ratio = formats.ratio(m.group())
        if formats.secret and ratio >= formats.least:
            found.append((m.start(), len(BASE_KINDS), m.end(), FORMAT, ratio))
    return [(kind, start, end, ratio) for start, _, end, kind, ratio in sorted(found)]


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string()), ("ratio", pa.float64())]))


def scanned(docs: DataFrame, formats: Formats, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and spans, an array of (kind, start, end, value,
    ratio) by start, then kind; code points, end exclusive.

    ``ratio`` is the likelihood ratio of the best credential format against
    ordinary words, per character. Base spans stay whatever their ratio. Null
    and empty texts have no spans; ids and repeated rows are passed through;
    without any labelled credential only the base patterns are used.
    """
    rows = picked(docs, id=id_col, text=text_col).withColumn("text", F.col("text").cast("string"))

    def run(batches):
        for part in chunks(batches, 1024):
            spans = []
            for text in part.column("text").to_pylist():
                spans.append([{"kind": k, "start": s, "end": e, "value": text[s:e], "ratio": r} for k, s, e, r in all_spans(text or "", formats)])
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(spans, _SPANS)], ["id", "spans"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, spans array<struct<kind: string, start: long, end: long, value: string, ratio: double>>")


def count_of(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def span_list(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest_columns() -> list[Column]:
    base = F.filter("spans", lambda s: s["kind"] != FORMAT)
    return [
        *(count_of(kind).alias(f"n_{kind}") for kind in BASE_KINDS),
        F.sha2(span_list(base).cast("binary"), 256).alias("base_sha256"),
        span_list(F.col("spans")).alias("spans"),
    ]
