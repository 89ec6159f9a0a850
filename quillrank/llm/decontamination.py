"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton is over words. Documents stream through it; the state reached by a word knows the longest run of
words, ending there, that any item contains, and so every window of an item that ends there. Benchmarks are cut
into blocks of bounded size, one automaton each, and every block passes over all documents without a shuffle.

Defined cases: null and empty texts have no words; items without words match nothing; items repeated under one id
count once; items with a null id are matched and hit words, but are not listed; columns beyond those named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from quillrank.llm.words import LETTERS_DIGITS, LOWERED_LETTERS_DIGITS, Words, cut, slices

WINDOW = 10
BLOCK_BYTES = 4 << 20  # of item texts in one automaton

SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])


class Automaton:
    """Suffix automaton of several sequences of words, with the items that own each window."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        ends: dict[int, set] = {}  # items with a prefix that ends in the state
        whole: dict[int, dict[int, set]] = {}  # items shorter than a window, by length
        pairs = set()
        lengths = set()
        for item, words in items:
            if not words:
                continue
            last = 0
            codes = [self.ids.setdefault(word, len(self.ids)) for word in words]
            lengths.add(min(window, len(codes)))
            pairs.update(zip(codes, codes[1:]))
            for code in codes:
                last = self._extend(last, code)
                ends.setdefault(last, set()).add(item)
            if len(codes) < window:
                whole.setdefault(last, {}).setdefault(len(codes), set()).add(item)
        self.shortest = min(lengths, default=0)
        self._own(ends, whole)
        self.words = list(self.ids)
        self.pairs = np.array(sorted(a * len(self.ids) + b for a, b in pairs), dtype=np.int64)

    def _extend(self, last: int, code: int) -> int:
        known = self.next[last].get(code)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, code, known)
        state = self._add(self.length[last] + 1, {})
        at = last
        while at >= 0 and code not in self.next[at]:
            self.next[at][code] = state
            at = self.link[at]
        if at < 0:
            self.link[state] = 0
        else:
            known = self.next[at][code]
            fits = self.length[known] == self.length[at] + 1
            self.link[state] = known if fits else self._split(at, code, known)
        return state

    def _add(self, length: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(0)
        return len(self.next) - 1

    def _split(self, at: int, code: int, known: int) -> int:
        """A state of its own for the shorter runs in ``known``, those that come from ``at``."""
        short = self._add(self.length[at] + 1, dict(self.next[known]))
        self.link[short] = self.link[known]
        self.link[known] = short
        while at >= 0 and self.next[at].get(code) == known:
            self.next[at][code] = short
            at = self.link[at]
        return short

    def _own(self, ends: dict, whole: dict) -> None:
        """Per state: the items with its window, and those short items that are a suffix of it."""
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            if state in ends and self.length[self.link[state]] >= self.window:
                ends.setdefault(self.link[state], set()).update(ends[state])
        self.owners = [
            frozenset(ends.get(state, ())) if self.length[state] >= self.window else None
            for state in range(len(self.length))
        ]
        # A short item lies within its state's runs, and in all states that link to it.
        self.short: list[tuple] = [()] * len(self.length)
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__):
            own = tuple((n, frozenset(items)) for n, items in whole.get(state, {}).items())
            self.short[state] = self.short[self.link[state]] + own

    def stream(self, words: list[bytes]) -> Iterator[tuple[int, int, int, frozenset]]:
        """``(start, end, longest match, items)`` for every window that occurs in ``words``."""
        state = length = 0
        for position, word in enumerate(words, 1):
            code = self.ids.get(word, -1)
            while state and code not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if code in self.next[state]:
                state = self.next[state][code]
                length += 1
            if length >= self.window:
                at = state
                while self.length[self.link[at]] >= self.window:
                    at = self.link[at]
                yield position - self.window, position, length, self.owners[at]
            for n, items in self.short[state]:
                if n <= length:
                    yield position - n, position, length, items


class Matcher:
    """Finds windows of items in the words of many texts. Only runs of pairs of words that items have are streamed."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton
        vocabulary = cut(pa.array([word.decode("utf-8", "replace") for word in automaton.words], pa.string()), False, LETTERS_DIGITS)
        prints = vocabulary.fingerprints() if automaton.words else np.zeros(0, np.uint64)
        self.order = np.argsort(prints)
        self.prints = prints[self.order]

    def runs(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """First word and end of the runs that may hold a window."""
        found = words.fingerprints()
        if not len(found) or not len(self.prints):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.prints, found), len(self.prints) - 1)
        known = self.prints[at] == found
        code = np.where(known, self.order[at], -1)
        # joined[i]: word i - 1 and word i are neighbours in an item and in one text
        joined = np.zeros(len(found) + 1, dtype=bool)
        if len(self.automaton.pairs):
            pair = code[:-1] * len(self.prints) + code[1:]
            place = np.minimum(np.searchsorted(self.automaton.pairs, pair), len(self.automaton.pairs) - 1)
            joined[1:-1] = known[:-1] & known[1:] & (self.automaton.pairs[place] == pair)
            joined[words.first] = False
        start = np.flatnonzero(known & ~joined[:-1])
        end = np.flatnonzero(known & ~joined[1:]) + 1
        long = end - start >= self.automaton.shortest
        return start[long], end[long]

    def hits(self, words: Words) -> dict[int, list[tuple[int, int, int, frozenset]]]:
        """By text: ``(start, end, longest match, items)``, in words of that text."""
        out: dict[int, list] = {}
        start, end = self.runs(words)
        texts = np.searchsorted(words.first, start, "right") - 1
        for a, b, text in zip(start.tolist(), end.tolist(), texts.tolist()):
            base = a - int(words.first[text])
            for low, high, longest, items in self.automaton.stream(words.texts(np.arange(a, b))):
                out.setdefault(text, []).append((base + low, base + high, longest, items))
        return out


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def _automata(items: DataFrame, window: int, block_bytes: int) -> Iterator[Automaton]:
    """One automaton per block. A block holds about ``block_bytes`` of item text, so the driver never has more."""
    rows = items.select(F.col("item_id").cast("string").alias("item"), "text").where(F.col("text").isNotNull())
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // block_bytes)
    for block in range(blocks):
        found = rows.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).toArrow()
        words = cut(found.column("text").combine_chunks(), True, LETTERS_DIGITS)
        texts = [words.texts(np.arange(a, b)) for a, b in zip(words.first[:-1], words.first[1:])]
        yield Automaton(list(zip(found.column("item").to_pylist(), texts)), window)


def find_items(
    documents: DataFrame,
    items: DataFrame,
    keep: Sequence[str] = ("doc_id", "text"),
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``(n_words, spans, longest, item_ids)`` beside the columns ``keep`` per row of ``documents``; ``text`` is one of them.

    ``spans`` are the runs of words that lie in an occurrence of a window, as ``[start, end)`` in words; a window
    is ``window`` consecutive words of an item, or a whole shorter item. ``longest`` is the longest match in words
    at any window, ``item_ids`` the items with occurring windows, sorted as strings.
    """
    frame = documents.select(
        *keep,
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast(T.ArrayType(SPAN)).alias("spans"),
        F.lit(0).cast("long").alias("longest"),
        F.array().cast("array<string>").alias("item_ids"),
    )
    schema = frame.schema
    for automaton in [*_automata(items, window, block_bytes)] or [Automaton([], window)]:
        frame = frame.mapInArrow(_pass(automaton), schema)
    return frame


def _pass(automaton: Automaton):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(automaton)
        for batch in slices(batches):
            words = cut(batch.column("text"), True, LETTERS_DIGITS)
            hits = matcher.hits(words)
            spans, longest, items = (batch.column(c).to_pylist() for c in ("spans", "longest", "item_ids"))
            for text, found in hits.items():
                old = [(s["start"], s["end"]) for s in spans[text]]
                spans[text] = [{"start": a, "end": b} for a, b in _merged(old + [hit[:2] for hit in found])]
                longest[text] = max(longest[text], *(hit[2] for hit in found))
                names = {name for hit in found for name in hit[3]} - {None}
                items[text] = sorted({*items[text], *names})
            columns = batch.columns[:-4] + [pa.array(words.counts, pa.int64())]
            columns += [pa.array(x, batch.schema.field(c).type) for c, x in (("spans", spans), ("longest", longest), ("item_ids", items))]
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return run


def n_hit() -> Column:
    """Words in the spans of a row of ``find_items``."""
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, span: n + span["end"] - span["start"])


def decontaminated(found: DataFrame, min_words: int = 1, max_coverage: float = 0.5) -> DataFrame:
    """The rows of ``find_items`` without contamination, with the columns that were kept there.

    Documents of whose words more than ``max_coverage`` are hit are removed; with 0.0 every hit removes. From the
    others, spans of at least ``min_words`` words are cut out of ``text``, with what separates them from the next word.
    """
    found = found.where(~(n_hit() > F.col("n_words") * F.lit(max_coverage)))
    columns = [name for name in found.columns if name not in ("n_words", "spans", "longest", "item_ids")]
    if max_coverage <= 0:
        return found.select(*columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = cut(batch.column("text"), False, LOWERED_LETTERS_DIGITS)
            texts = batch.column("text").to_pylist()
            for i, spans in enumerate(batch.column("spans").to_pylist()):
                long = [span for span in spans if span["end"] - span["start"] >= min_words]
                if long:
                    texts[i] = _without(words, i, long).decode()
            new = {"text": pa.array(texts, batch.schema.field("text").type)}
            yield pa.RecordBatch.from_arrays([new.get(name, batch.column(name)) for name in columns], names=columns)

    return found.select(*columns, "spans").mapInArrow(run, found.select(*columns).schema)


def _without(words: Words, text: int, spans: list[dict]) -> bytes:
    first, stop, at = int(words.first[text]), int(words.first[text + 1]), int(words.bounds[text])
    parts = []
    for span in spans:
        parts.append(words.data[at : words.start[first + span["start"]]].tobytes())
        after = first + span["end"]
        at = int(words.start[after] if after < stop else words.bounds[text + 1])
    return b"".join([*parts, words.data[at : words.bounds[text + 1]].tobytes()])
