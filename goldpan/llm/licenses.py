"""License scans: templates with optional and replaceable regions, compiled to token automata.

A template is wording with two kinds of marks::

    <<optional>> ... <</optional>>      the wording may be left out
    <<var:PATTERN>>                     one word that matches PATTERN in full
    <<var:PATTERN:MIN-MAX>>             MIN to MAX such words

Everything else is mandatory, word by word.  Words are compared without case and punctuation, so layout does not matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The phrases whose places are always reported.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Wording of well-known grants and notices.  Label -> templates.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "apache-2.0": (
        "licensed under the apache license<<optional>> version<</optional>> 2<<optional>> 0<</optional>>",
        "apache license version 2 0<<optional>> january 2004<</optional>>",
    ),
    "mit": (
        "<<optional>>this <<var:software|work|project|code|program>> is <</optional>><<var:released|licensed|distributed|available>> under the"
        "<<optional>> terms of the<</optional>> mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"
        "<<optional>> the software<</optional>> to deal in the software without restriction",
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        "<<var:released|licensed|distributed>> under the <<optional>>terms of the <</optional>><<optional>><<var:2|3|two|three|new|simplified|modified>>"
        " <<optional>>clause <</optional>><</optional>>bsd license",
    ),
    "isc": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that"
        " the above copyright notice and this permission notice appear in all copies",
    ),
    "mpl-2.0": ("subject to the terms of the mozilla public license<<optional>> v<</optional>> 2 0", "mozilla public license version 2 0"),
    "gpl-3.0": (
        "<<optional>>this <<var:work|program|software|file>> is <</optional>>licensed under the gnu general public license<<optional>> version<</optional>> <<var:v?3>>",
    ),
    "gpl-2.0": (
        "<<optional>>this <<var:work|program|software|file>> is <</optional>>licensed under the gnu general public license<<optional>> version<</optional>> <<var:v?2>>",
    ),
    "gpl-or-later": (
        "redistribute it and or modify it under the terms of the gnu<<optional>> lesser<</optional>> general public license as published by the"
        " free software foundation either version <<var:[23]>><<optional>> <<var:[0-9]>><</optional>> of the license or at your option any later version",
    ),
    "cc-by-4.0": ("licensed under<<optional>> a<</optional>> cc by <<var:[1-4]>> 0",
                  "licensed under a creative commons attribution <<var:[1-4]>> 0 <<optional>>international <</optional>>license"),
    "cc-by-nc-4.0": ("licensed under<<optional>> a<</optional>> cc by nc <<var:[1-4]>> 0",
                     "licensed under a creative commons attribution noncommercial <<var:[1-4]>> 0 <<optional>>international <</optional>>license"),
    "cc-by-sa-4.0": ("licensed under<<optional>> a<</optional>> cc by sa <<var:[1-4]>> 0",
                     "licensed under a creative commons attribution sharealike <<var:[1-4]>> 0 <<optional>>international <</optional>>license"),
    "cc0": ("cc0 <<optional>><<var:1>> 0 <</optional>>universal", "dedicated to the public domain"),
    "copyright": ("copyright <<optional>>c <</optional>><<var:[12][0-9]{3}>> <<var:.+:1-6>> all rights reserved",),
}

_MARK = re.compile(r"<<(/?optional|var:[^<>]*)>>")
# A-Z become a-z; ASCII signs and white space separate words; every byte of a longer UTF-8 sequence belongs to a word
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def license_words(text: str | None) -> list[bytes]:
    """Runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split() if text else []


@dataclass(frozen=True)
class Step:
    """One word of a template: given, or any that matches a pattern."""

    word: bytes | None
    pattern: re.Pattern[str] | None

    def takes(self, word: bytes) -> bool:
        return word == self.word if self.pattern is None else self.pattern.fullmatch(word.decode("utf-8", "replace")) is not None


class TokenAutomaton:
    """Positions 0..n between the words of one template; the last accepts.  Optional regions are moves without a word."""

    def __init__(self, template: str) -> None:
        self.steps: list[Step] = []
        jumps: dict[int, set[int]] = {}
        opened: list[int] = []
        for n, part in enumerate(_MARK.split(template)):
            if n % 2 == 0:
                self.steps += [Step(w, None) for w in license_words(part)]
            elif part == "optional":
                opened.append(len(self.steps))
            elif part == "/optional":
                if not opened:
                    raise ValueError(f"region is closed twice: {template!r}")
                jumps.setdefault(opened.pop(), set()).add(len(self.steps))
            else:
                body, _, counts = part.removeprefix("var:").partition(":")
                least, _, most = (counts or "1-1").partition("-")
                for k in range(int(most)):
                    if k >= int(least):
                        jumps.setdefault(len(self.steps), set()).add(len(self.steps) + int(most) - k)
                    self.steps.append(Step(None, re.compile(body)))
        if opened:
            raise ValueError(f"region is not closed: {template!r}")
        self.accept = len(self.steps)
        self.closure = [self._reach(p, jumps) for p in range(self.accept + 1)]
        if self.accept in self.closure[0]:
            raise ValueError(f"template without mandatory words: {template!r}")
        # words that must be there, for a quick look before the automaton runs
        skipped = {p for start, ends in jumps.items() for end in ends for p in range(start, end)}
        self.mandatory = [s.word for p, s in enumerate(self.steps) if s.word and p not in skipped]

    def _reach(self, position: int, jumps: dict[int, set[int]]) -> frozenset[int]:
        seen, open_ = {position}, [position]
        while open_:
            for p in jumps.get(open_.pop(), ()):
                if p not in seen:
                    seen.add(p)
                    open_.append(p)
        return frozenset(seen)

    def matches(self, words: Sequence[bytes]) -> list[tuple[int, int]]:
        """Start and end (exclusive) of every accepted run; of runs that end at one place the latest start is kept."""
        found = []
        states: dict[int, int] = {}  # position -> start of the run that is there
        for at, word in enumerate(words):
            states |= dict.fromkeys(self.closure[0], at)
            following: dict[int, int] = {}
            for position, start in states.items():
                if position < self.accept and self.steps[position].takes(word):
                    for p in self.closure[position + 1]:
                        following[p] = max(start, following.get(p, -1))
            if self.accept in following:
                found.append((following.pop(self.accept), at + 1))
            states = following
        return found


class LicenseScanner:
    """Places of fixed phrases and accepted templates in one text."""

    def __init__(self, phrases: Mapping[str, str] = PHRASES, templates: Mapping[str, Sequence[str]] = TEMPLATES) -> None:
        self.phrases = [(b" %b " % b" ".join(license_words(p)), len(license_words(p)), label) for p, label in phrases.items()]
        self.automata = [(label, TokenAutomaton(t)) for label, ts in templates.items() for t in ts]
        # a text is run through an automaton only around one of its mandatory words, the longest
        self.keys = [b" %b " % max(a.mandatory, key=len) for _, a in self.automata]

    def scan(self, text: str | None) -> tuple[int, int, int | None, int | None, set[str], set[str], int]:
        """Words, phrase places, first and last place, phrase labels, template labels, words under phrases or templates."""
        words = license_words(text)
        line = b" %b " % b" ".join(words)
        places, base, covered = [], set(), set()
        for phrase, length, label in self.phrases:
            at = line.find(phrase)
            while at >= 0:
                start = line.count(b" ", 0, at + 1) - 1
                places.append(start)
                covered.update(range(start, start + length))
                base.add(label)
                at = line.find(phrase, at + 1)
        labels = set()
        for (label, automaton), key in zip(self.automata, self.keys, strict=True):
            reach = len(automaton.steps)
            at = line.find(key)
            while at >= 0:
                near = line.count(b" ", 0, at + 1) - 1
                begin = max(0, near - reach)
                for start, end in automaton.matches(words[begin:near + reach + 1]):
                    labels.add(label)
                    covered.update(range(begin + start, begin + end))
                at = line.find(key, at + 1)
        return len(words), len(places), min(places, default=None), max(places, default=None), base, labels, len(covered)


def scan_licenses(docs: DataFrame, phrases: Mapping[str, str] = PHRASES, templates: Mapping[str, Sequence[str]] = TEMPLATES,
                  id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """License phrases and templates of every row.

    A null or empty text has no words, no places, empty label lists and score 0; a text of any length is scanned whole; repeated rows
    give repeated results.  Only the id and the text are read.  ``score`` is 0 without any label, else 0.5 plus half the share of
    words that belong to license wording.
    """
    schema = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"

    @F.pandas_udf(schema)
    def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scanner = LicenseScanner(phrases, templates)
        for texts in batches:
            rows = []
            for text in texts:
                n, places, first, last, base, labels, covered = scanner.scan(text)
                every = base | labels
                score = 0.5 + 0.5 * covered / n if every else 0.0
                rows.append((n, places, first, last, ",".join(sorted(base)), ",".join(sorted(every)), score))
            frame = pd.DataFrame(rows, columns=["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])
            yield frame.astype({"n_words": "int64", "n_base": "int64", "first_word": "Int64", "last_word": "Int64", "score": "float64"})

    return docs.select(F.col(id_column), scanned(F.col(text_column)).alias("scan")).select(id_column, "scan.*")
