"""Licence scans: Aho-Corasick finds notice phrases and identifier tags; a shunting-yard parser reads expressions.

A text is reduced to its words (ASCII letters lowered; signs below 128 part words), joined by single spaces.
One automaton over the phrases, each between spaces, reports every place, overlaps included. Tag words, such as
those of an SPDX tag, are phrases too; behind such a place the raw text is read as a licence expression of ``and``,
``or``, ``with``, brackets and ``/`` (an older ``or``). The parser turns it into postfix order, and its
evaluation gives the labels that it names and whether a set of accepted licences permits the work.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, bounded_batches, per_batch, renamed

# Phrases that are counted as base places, and their labels: fixed values.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Further phrases of licence notices: label and how much one place tells, 0 to 1.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software": ("mit", 0.95),
    "licensed under the apache license": ("apache", 0.95),
    "redistribution and use in source and binary forms with or without modification are permitted": ("bsd", 0.95),
    "under the terms of the gnu general public license": ("gpl", 0.95),
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": ("isc", 0.95),
    "this is free and unencumbered software released into the public domain": ("unlicense", 0.95),
    "lesser general public license": ("lgpl", 0.8),
    "affero general public license": ("agpl", 0.8),
    "mozilla public license": ("mpl", 0.8),
    "eclipse public license": ("epl", 0.8),
    "boost software license": ("bsl", 0.8),
    "common development and distribution license": ("cddl", 0.8),
    "european union public licence": ("eupl", 0.8),
    "creative commons attribution": ("cc-by", 0.8),
    "creative commons zero": ("cc0", 0.8),
    "bsd license": ("bsd", 0.6),
    "isc license": ("isc", 0.6),
    "zlib license": ("zlib", 0.6),
    "artistic license": ("artistic", 0.6),
}
BASE_WEIGHT = 0.6
TAG_WEIGHT, BROKEN_WEIGHT = 0.98, 0.2

# Words of tags, and whether a tag that holds no valid expression still counts as a broken one.
TAGS = {"spdx license identifier": True, "license expression": True, "license": False}

# Beginnings of licence identifiers and their labels; the longest that ends at a sign or the end counts.
FAMILIES = {
    "mit": "mit", "mit-0": "mit", "apache": "apache", "gpl": "gpl", "lgpl": "lgpl", "agpl": "agpl", "bsd": "bsd",
    "0bsd": "bsd", "mpl": "mpl", "epl": "epl", "bsl": "bsl", "isc": "isc", "zlib": "zlib", "unlicense": "unlicense",
    "cc0": "cc0", "cc-by": "cc-by", "cddl": "cddl", "eupl": "eupl", "artistic": "artistic", "licenseref": "other",
    "python": "python", "psf": "python", "ofl": "ofl", "wtfpl": "wtfpl", "postgresql": "postgresql", "x11": "mit",
}
EXCEPTIONS = (
    "classpath-exception-2.0", "gcc-exception-3.1", "llvm-exception", "bison-exception-2.2", "font-exception-2.0",
    "linux-syscall-note", "autoconf-exception-3.0", "openjdk-assembly-exception-1.0", "universal-foss-exception-1.0",
)
PERMISSIVE = frozenset({"mit", "apache", "bsd", "isc", "zlib", "unlicense", "cc0", "bsl", "python", "postgresql"})

_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_IN_WORD = np.frombuffer(_WORDS, np.uint8) != 32
_VALUE = re.compile(rb"[\"']?[ \t]*[:=][ \t]*[\"']?")
_TOKEN = re.compile(rb"[ \t]*([()/]|[A-Za-z0-9][A-Za-z0-9.+:-]*)")
_RANK = {"or": 1, "/": 1, "and": 2, "with": 3}


def family(name: str) -> str | None:
    """The label of a licence identifier, or nothing where it is unknown."""
    name = name.rstrip("+")
    while name:
        if name in FAMILIES:
            return FAMILIES[name]
        name = name[:max(name.rfind("-"), name.rfind("."), 0)]
    return None


def parse(text: bytes, at: int = 0) -> list[str] | None:
    """The licence expression that begins at ``at``, in postfix order; nothing where none does.

    Operators bind as ``with``, ``and``, ``or``; equal ones from the left. Reading stops where the expression can't go on;
    what was whole outside brackets by then counts. The right side of ``with`` is an exception, all else a licence.
    """
    out: list[str] = []
    waiting: list[str] = []
    depth, operand = 0, True
    kept: int | None = None  # how much of ``out`` was whole, and the operators then waiting
    pending: list[str] = []

    def whole() -> list[str] | None:
        return None if kept is None else out[:kept] + pending

    while True:
        if not operand and not depth:
            kept, pending = len(out), waiting[::-1]
        found = _TOKEN.match(text, at)
        if not found:
            return whole()
        token, at = found[1].decode().lower(), found.end()
        if operand:
            if token == "(" and waiting[-1:] != ["with"]:
                waiting.append(token)
                depth += 1
                continue
            token = token.rstrip(".:-")
            known = token in EXCEPTIONS if waiting[-1:] == ["with"] else family(token)
            if not known:
                return whole()
            out.append(token)
            operand = False
        elif token in _RANK:
            if token == "with" and out[-1] in _RANK:  # an exception belongs to one licence
                return whole()
            while waiting and waiting[-1] != "(" and _RANK[waiting[-1]] >= _RANK[token]:
                out.append(waiting.pop())
            waiting.append(token)
            operand = True
        elif token == ")" and depth:
            while waiting[-1] != "(":
                out.append(waiting.pop())
            waiting.pop()
            depth -= 1
        else:
            return whole()


@dataclass(frozen=True)
class Verdict:
    """What an expression says: canonical text, labels, and whether the accepted licences permit the work."""

    text: str
    labels: frozenset[str]
    permitted: bool
    rank: int = field(default=4, compare=False)


def evaluate(postfix: Sequence[str], accepted: frozenset[str] = PERMISSIVE) -> Verdict:
    """``or`` is permitted by either side, ``and`` by both, and an exception leaves its licence as it is."""
    def inner(v: Verdict, rank: int) -> str:
        return f"({v.text})" if v.rank < rank else v.text

    stack: list[Verdict] = []
    for token in postfix:
        rank = _RANK.get(token)
        if rank is None:
            label = family(token)
            labels = frozenset() if token in EXCEPTIONS or label is None else frozenset({label})
            stack.append(Verdict(token, labels, bool(labels & accepted)))
            continue
        b, a = stack.pop(), stack.pop()
        name = "or" if rank == 1 else token
        permitted = a.permitted if name == "with" else a.permitted and b.permitted if name == "and" else a.permitted or b.permitted
        stack.append(Verdict(f"{inner(a, rank)} {name} {inner(b, rank)}", a.labels | b.labels, permitted, rank))
    return stack[0]


class Scanner:
    """One automaton over base phrases, notices and tags."""

    def __init__(self, base: Mapping[str, str] = BASE, notices: Mapping[str, tuple[str, float]] = NOTICES,
                 accepted: frozenset[str] = PERMISSIVE) -> None:
        import ahocorasick

        self.base, self.notices, self.accepted = dict(base), dict(notices), accepted
        self.automaton = ahocorasick.Automaton()
        for phrase in {*base, *notices, *TAGS}:
            self.automaton.add_word(f" {phrase} ".encode().decode("latin-1"), (phrase, len(phrase.split())))
        self.automaton.make_automaton()

    def places(self, data: bytes) -> tuple[int, list[tuple[int, str, int]]]:
        """Number of words, and ``(first word, phrase, words in it)`` of every place in order."""
        words = data.translate(_WORDS).split()
        line = f" {b' '.join(words).decode('latin-1')} "
        found = [(end, phrase, n) for end, (phrase, n) in self.automaton.iter(line)]
        if found:
            gaps = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
            last = np.searchsorted(gaps, [end for end, _, _ in found])  # words up to the end of each place
            found = sorted((int(at) - n, phrase, n) for at, (_, phrase, n) in zip(last, found, strict=True))
        return len(words), found

    def expressions(self, data: bytes, places: list[tuple[int, str, int]]) -> list[tuple[int, Verdict | None]]:
        """``(word, verdict)`` of the tags; none for a broken one. A shorter tag inside a longer one is passed over."""
        tags = [p for p in places if p[1] in TAGS]
        if not tags:
            return []
        inside = _IN_WORD[np.frombuffer(data, np.uint8)]
        ends = np.flatnonzero(inside & ~np.append(inside[1:], False)) + 1
        out, covered = [], -1
        for first, phrase, n in sorted(tags, key=lambda p: (p[0], -p[2])):
            if first < covered:
                continue
            value = _VALUE.match(data, ends[first + n - 1])
            postfix = parse(data, value.end()) if value else None
            if postfix:
                out.append((first, evaluate(postfix, self.accepted)))
            elif value and TAGS[phrase]:
                out.append((first, None))
            covered = first + n
        return out

    def __call__(self, text: bytes | None) -> dict:
        data = text or b""
        n_words, places = self.places(data)
        stated = self.expressions(data, places)
        own = [(first, self.base[phrase]) for first, phrase, _ in places if phrase in self.base]
        labels = {label for _, label in own}
        doubt = 1.0
        for phrase in {phrase for _, phrase, _ in places}:  # a phrase tells the same however often it stands
            if phrase in self.notices:
                labels.add(self.notices[phrase][0])
                doubt *= 1 - self.notices[phrase][1]
            if phrase in self.base:
                doubt *= 1 - BASE_WEIGHT
        texts: dict[str | None, Verdict | None] = {v.text if v else None: v for _, v in stated}
        for verdict in texts.values():
            labels |= verdict.labels if verdict else set()
            doubt *= 1 - (TAG_WEIGHT if verdict else BROKEN_WEIGHT)
        whole = [v for v in texts.values() if v]
        return {
            "n_words": n_words, "n_base": len(own), "first_word": own[0][0] if own else None,
            "last_word": own[-1][0] if own else None, "base_labels": ",".join(sorted({label for _, label in own})),
            "labels": ",".join(sorted(labels)), "score": 1 - doubt, "expressions": sorted(v.text for v in whole),
            "permitted": all(v.permitted for v in whole) if whole else None,
        }


_SCANNED = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("expressions", pa.list_(pa.string())),
    ("permitted", pa.bool_())])


def _mapped(docs: DataFrame, id_col: str, text_col: str, run: Callable, fields: str) -> DataFrame:
    bounded_batches(docs.sparkSession)
    rows = renamed(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("bigint"))
    return rows.mapInArrow(per_batch(run), fields)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", accepted: frozenset[str] = PERMISSIVE,
         base: Mapping[str, str] = BASE, notices: Mapping[str, tuple[str, float]] = NOTICES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score,
    expressions, permitted``.

    ``n_base`` counts all places of base phrases and ``first_word`` and ``last_word`` are the smallest and largest
    word they begin at. ``labels`` adds those of notices and of valid expressions. ``score`` combines the weights of the
    different phrases and expressions by noisy-or. ``permitted`` tells whether all stated expressions are, and is null without one.

    Null, empty and wordless texts have no words, no labels (empty strings) and score 0. Repeated rows and null ids
    are rows like others, an empty table gives none, and other columns are ignored. Texts are read whole.
    """
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scanner = Scanner(base, notices, accepted)
        rows = [{"doc_id": i, **scanner(t)} for i, t in zip(batch.column("id").to_pylist(), as_bytes(batch.column("text")), strict=True)]
        return pa.RecordBatch.from_pylist(rows, schema=_SCANNED)

    return _mapped(docs, id_col, text_col, run,
                   "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
                   "labels string, score double, expressions array<string>, permitted boolean")


def locate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, word, phrase, label)`` of every place of a base phrase or notice; a phrase that is both has its base label."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scanner = Scanner()
        rows = []
        for doc, text in zip(batch.column("id").to_pylist(), as_bytes(batch.column("text")), strict=True):
            for first, phrase, _ in scanner.places(text or b"")[1]:
                if label := scanner.base.get(phrase) or (scanner.notices[phrase][0] if phrase in scanner.notices else None):
                    rows.append({"doc_id": doc, "word": first, "phrase": phrase, "label": label})
        return pa.RecordBatch.from_pylist(rows, schema=pa.schema(
            [("doc_id", pa.int64()), ("word", pa.int64()), ("phrase", pa.string()), ("label", pa.string())]))

    return _mapped(docs, id_col, text_col, run, "doc_id bigint, word bigint, phrase string, label string")
