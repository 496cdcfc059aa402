"""License notices: exact phrases, and fuzzy search for short notices."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from omnishelf.llm.common import kept_for, ready

# The base phrases and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Short notices, as words, and the label a fuzzy hit gives.
NOTICES = {
    "licensed under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the apache license version 2 0": "apache-2",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "creative commons attribution noncommercial": "cc-by-nc",
    "licensed under cc by 4 0": "cc-by",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "creative commons attribution sharealike": "cc-by-sa",
    "licensed under the gnu general public license version 3": "gpl-3",
    "licensed under the gnu general public license version 2": "gpl-2",
    "under the terms of the gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "subject to the terms of the mozilla public license v 2 0": "mpl-2",
    "redistribution and use in source and binary forms": "bsd",
    "permission to use copy modify and or distribute this software": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "released under the eclipse public license": "epl",
}

# One edit (inserted, deleted or changed character) is allowed for so many characters of a notice.
CHARS_PER_EDIT = 12

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
# Numbers and short marks tell notices apart, so they are not left to the edits.
_MARK = re.compile(r"\b(?:\d|by|nc|sa|nd|v)\b")


def pieces(notice: str, edits: int) -> list[tuple[int, str]]:
    """``edits + 1`` pieces with their offsets: any text within the edits holds one unchanged."""
    size, out = len(notice) / (edits + 1), []
    for k in range(edits + 1):
        lo, hi = round(k * size), round((k + 1) * size)
        out.append((lo, notice[lo:hi]))
    return out


class Scanner:
    """Exact seeds of all notices in one automaton, and a bounded-error pattern for each notice."""

    def __init__(self, notices: dict[str, str] | None = None):
        import ahocorasick
        import regex

        self.notices = list((NOTICES if notices is None else notices).items())
        self.seeds = ahocorasick.Automaton()
        self.patterns, self.edits = [], []
        seeds: dict[str, list[tuple[int, int]]] = {}
        for i, (notice, _) in enumerate(self.notices):
            edits = max(1, len(notice) // CHARS_PER_EDIT)
            self.edits.append(edits)
            fuzzy = regex.compile(rf"(?be)(?<![^ ])(?:{regex.escape(notice)}){{e<={edits}}}(?![^ ])")
            self.patterns.append(fuzzy)
            for at, piece in pieces(notice, edits):
                seeds.setdefault(piece, []).append((i, at))
        for piece, uses in seeds.items():
            self.seeds.add_word(piece, (len(piece), uses))
        self.seeds.make_automaton()
        words = {p: p.split() for p in BASE}
        gap = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
        inside = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
        # Looked at from each start, so that places may overlap.
        self.base = [
            (w[-1], re.compile(rf"(?<!{inside})(?={gap.join(w)}(?!{inside}))"), BASE[p])
            for p, w in words.items()
        ]

    def candidates(self, line: str) -> dict[int, list[list[int]]]:
        """Per notice the stretches that may hold it, in order. Seeds whose windows start within the
        edits of each other belong to one place; a stretch is never much longer than the notice."""
        starts: dict[int, set[int]] = {}
        for end, (size, uses) in self.seeds.iter(line):
            for i, at in uses:
                starts.setdefault(i, set()).add(max(0, end + 1 - size - at - self.edits[i]))
        found: dict[int, list[list[int]]] = {}
        for i, places in starts.items():
            edits, spans = self.edits[i], []
            reach = len(self.notices[i][0]) + 3 * edits
            for lo in sorted(places):
                if spans and lo <= spans[-1][0] + 2 * edits:
                    spans[-1][1] = min(len(line), lo + reach)
                else:
                    spans.append([lo, min(len(line), lo + reach)])
            found[i] = spans
        return found

    def fuzzy(self, line: str) -> list[tuple[int, int, int, int]]:
        """(notice, start, stop, edits) in ``line``, words joined by single blanks.

        Stretches are searched once from left to right, each behind the last notice found, so the
        work grows with the text however many notices stand in it.
        """
        hits = []
        for i, stretches in self.candidates(line).items():
            marks = _MARK.findall(self.notices[i][0])
            done = 0
            for lo, hi in stretches:
                spans = [[max(lo, done), hi]]
                while spans:
                    lo, hi = spans.pop()
                    m = self.patterns[i].search(line, lo, hi) if lo < hi else None
                    if not m or m.start() == m.end():
                        continue
                    if not marks or marks == _MARK.findall(m[0]):
                        hits.append((i, m.start(), m.end(), sum(m.fuzzy_counts)))
                        done = max(done, m.end())
                    # The best match need not be the only one: what lies before and behind it too.
                    spans += [[lo, m.start()], [m.end(), hi]]
        return hits

    def scan(self, text: str | None) -> tuple:
        """n_words, n_base, first_word, last_word, base labels, labels, score, fuzzy hits."""
        low = (text or "").translate(_LOWER) if text and not text.isascii() else (text or "").lower()
        words = WORD.findall(low)
        starts, base = [], set()
        for last, pattern, label in self.base:
            if last in low:
                places = [m.start() for m in pattern.finditer(low)]
                if places:
                    base.add(label)
                    starts += places
        first = last = None
        if starts:
            count = lambda stop: sum(1 for _ in WORD.finditer(low, 0, stop))
            first, last = count(min(starts)), count(max(starts))
        line = " ".join(words)
        hits = self.fuzzy(line)
        labels = base | {self.notices[i][1] for i, *_ in hits}
        best = max([1 - e / len(self.notices[i][0]) for i, _, _, e in hits], default=0.0)
        score = 1.0 if base else best
        found, at, counted = [], 0, 0
        for i, lo, hi, edits in sorted(hits, key=lambda h: (h[1], h[0])):
            at, counted = at + line.count(" ", counted, lo), lo
            found.append({"notice": self.notices[i][0], "label": self.notices[i][1], "first_word": at,
                          "n_words": line.count(" ", lo, hi) + 1, "edits": edits})
        return (len(words), len(starts), first, last, ",".join(sorted(base)),
                ",".join(sorted(labels)), score, found)


_HIT = pa.struct([("notice", pa.string()), ("label", pa.string()), ("first_word", pa.int64()),
                  ("n_words", pa.int64()), ("edits", pa.int64())])
_COLUMNS = [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
            ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()),
            ("score", pa.float64()), ("notices", pa.list_(_HIT))]


def _scan(batches: Iterator[pa.RecordBatch]):
    kept = kept_for("licenses")
    scanner = kept["scanner"] = kept.get("scanner") or Scanner()
    for batch in batches:
        rows = [scanner.scan(t.as_py()) for t in batch.column(1)]
        columns = zip(*rows, strict=True) if rows else [[]] * len(_COLUMNS)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(c, k) for c, (_, k) in zip(columns, _COLUMNS, strict=True)]],
            ["doc_id", *[n for n, _ in _COLUMNS]],
        )


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Per row the base phrases and the notices found in its whole text; no shuffle.

    Words are runs of letters, digits and characters beyond ASCII, in lower case (A-Z). A base
    phrase counts wherever its words stand consecutively. Notices are searched in the words joined
    by single blanks: a notice with e edits is split into e + 1 pieces, one of which any text within
    the edits holds unchanged; the pieces are found exactly, and the stretches around them are
    matched with at most e errors. Numbers and marks such as "nc" must agree. notices lists the
    matches (words from 0, edits); score is 1 with a base phrase, else the best match's share of
    unchanged characters, else 0. A null or empty text has no words and score 0; repeated rows are
    scanned each, other columns are not read, an empty table gives an empty result.
    """
    ready(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _scan,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double, notices array<struct<notice:string,"
        "label:string,first_word:long,n_words:long,edits:long>>",
    )
