"""License scans: ordered signature rules behind a keyword prefilter.

A rule is (label, keyword, regular expression, priority).  A text is reduced to
its lower-case words joined by spaces; one pass of an Aho-Corasick machine over
the rules' keywords says which rules can match at all, and only these run.
Detections are resolved in order of priority: one that lies within the interval
of a kept detection of equal or higher priority is suppressed (a "gpl" within a
"gpl 3.0 or later" notice says nothing new).

``n_base`` and the base labels come from four fixed phrases, counted at every
place where their words stand consecutively; a base label is never suppressed.

A null text counts as empty: no words, no labels, score 0.  Equal rows give equal
results; other columns of the input are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from gleaner.session import ship

#: The base phrases and their labels.
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))


@dataclass(frozen=True)
class Rule:
    """Patterns see lower-case words with one space between them and around the text."""

    label: str
    keyword: str
    pattern: str
    priority: int


def _version(v: str) -> str:
    """'2.0' as words: points are separators, and '.0' is often left out."""
    a, _, b = v.partition(".")
    return rf"(?:v|version|v )? ?{a}" + (rf"(?: {b})?" if b == "0" else rf" {b}")


def build_rules() -> tuple[Rule, ...]:
    rules: list[Rule] = []

    def add(label: str, keyword: str, pattern: str, priority: int = 50) -> None:
        rules.append(Rule(label, keyword, rf"(?<= ){pattern}(?= )", priority))

    later = r"(?: (?:only )?or (?:\(?at your option\)? )?(?:any )?later(?: version)?)"
    # the GNU family, named in full, by abbreviation and by SPDX name
    for label, long, short, versions in (
        ("gpl", "general public license", "gpl", ("1.0", "2.0", "3.0")),
        ("lgpl", "(?:lesser|library) general public license", "lgpl", ("2.0", "2.1", "3.0")),
        ("agpl", "affero general public license", "agpl", ("1.0", "3.0")),
        ("fdl", "free documentation license", "gfdl", ("1.1", "1.2", "1.3")),
    ):
        name = rf"(?:(?:the )?gnu )?(?:{long}|{short})"
        for v in versions:
            add(f"{label}-{v}-or-later", "public" if label != "fdl" else "documentation", rf"{name} {_version(v)}{later}", 90)
            add(f"{label}-{v}", "public" if label != "fdl" else "documentation", rf"{name} {_version(v)}(?: only)?", 80)
            add(f"{label}-{v}-or-later", short, rf"{short} ?{_version(v)}(?:{later}| plus)", 88)
            add(f"{label}-{v}", short, rf"{short} ?{_version(v)}(?: only)?", 78)
        add(label, "gnu", rf"gnu {long}", 60)
        add(label, short, rf"{short}", 40)
    add("gpl-with-classpath-exception", "classpath", r"classpath exception", 85)
    add("gpl-with-linking-exception", "linking", r"linking exception", 84)
    add("gpl-notice", "redistribute", r"redistribute it and or modify it under the terms of the gnu general public license", 86)
    # Apache
    for v in ("1.0", "1.1", "2.0"):
        add(f"apache-{v}", "apache", rf"(?:the )?apache(?: software)? license {_version(v)}", 80)
        add(f"apache-{v}", "apache", rf"apache {v.replace('.', ' ')}", 70)
    add("apache", "apache", r"apache(?: software)? license", 50)
    add("apache", "apache", r"licensed under the apache", 45)
    # Creative Commons: every kind by every version, then by kind, then at all
    kinds = {"cc-by": "by", "cc-by-sa": "by sa", "cc-by-nc": "by nc", "cc-by-nd": "by nd", "cc-by-nc-sa": "by nc sa", "cc-by-nc-nd": "by nc nd"}
    names = {"by": "attribution", "sa": "share ?alike", "nc": "non ?commercial", "nd": "no ?deriv(?:ative)?s?"}
    for label, kind in kinds.items():
        n = len(kind.split())
        words = " ".join(names[x] for x in kind.split())
        for v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            add(f"{label}-{v}", "cc", rf"cc {kind} {_version(v)}", 80 + n)
            add(f"{label}-{v}", "creative", rf"creative commons {words} {_version(v)}", 80 + n)
            add(f"{label}-{v}", "creativecommons", rf"creativecommons org licenses {kind} {v.replace('.', ' ')}", 90)
        add(label, "cc", rf"cc {kind}", 50 + n)
        add(label, "creative", rf"creative commons {words}", 50 + n)
    add("cc0-1.0", "cc0", r"cc0(?: 1 0)?", 80)
    add("cc0-1.0", "publicdomain", r"creativecommons org publicdomain zero 1 0", 90)
    add("cc0-1.0", "zero", r"creative commons zero", 80)
    add("creative-commons", "creative", r"creative commons(?: license)?", 30)
    # permissive licenses
    add("mit", "mit", r"(?:the )?(?:mit|expat) license", 60)
    add("mit", "mit", r"(?:licensed|released|distributed) under (?:the )?mit", 55)
    add("mit", "granted", r"permission is hereby granted free of charge to any person obtaining a copy of this software", 85)
    add("mit-0", "mit", r"mit no attribution", 82)
    add("x11", "x11", r"x11 license", 60)
    add("isc", "isc", r"isc license", 60)
    add("isc", "permission", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", 85)
    for n, word in ((0, "zero"), (1, "one"), (2, "two"), (3, "three"), (4, "four")):
        add(f"bsd-{n}-clause", "bsd", rf"(?:bsd (?:{n}|{word}) clause(?: license)?|(?:{n}|{word}) clause bsd(?: license)?)", 80)
    add("bsd-3-clause", "bsd", r"(?:new|modified|revised) bsd license", 75)
    add("bsd-2-clause", "bsd", r"(?:simplified|freebsd) bsd license", 75)
    add("bsd", "bsd", r"bsd(?: style)? license", 50)
    add("bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted", 70)
    add("zlib", "zlib", r"zlib(?: libpng)? license", 60)
    add("boost-1.0", "boost", r"boost software license(?: version)?(?: 1 0)?", 70)
    add("unlicense", "unlicense", r"(?:the )?unlicense", 60)
    add("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain", 85)
    add("wtfpl", "wtfpl", r"wtfpl", 60)
    add("public-domain", "domain", r"(?:in|into|to) the public domain", 40)
    # named licenses with versions: (label, keyword, name, versions)
    for label, keyword, name, versions in (
        ("mpl", "mozilla", r"mozilla public license", ("1.0", "1.1", "2.0")),
        ("mpl", "mpl", r"mpl", ("1.0", "1.1", "2.0")),
        ("epl", "eclipse", r"eclipse public license", ("1.0", "2.0")),
        ("epl", "epl", r"epl", ("1.0", "2.0")),
        ("cddl", "cddl", r"cddl", ("1.0", "1.1")),
        ("cddl", "common", r"common development and distribution license", ("1.0", "1.1")),
        ("cpl", "common", r"common public license", ("1.0",)),
        ("eupl", "european", r"european union public licen[cs]e", ("1.0", "1.1", "1.2")),
        ("eupl", "eupl", r"eupl", ("1.0", "1.1", "1.2")),
        ("artistic", "artistic", r"(?:the )?artistic license", ("1.0", "2.0")),
        ("afl", "academic", r"academic free license", ("1.1", "1.2", "2.0", "2.1", "3.0")),
        ("osl", "open", r"open software license", ("1.0", "1.1", "2.0", "2.1", "3.0")),
        ("ofl", "sil", r"sil open font license", ("1.0", "1.1")),
        ("ofl", "ofl", r"ofl", ("1.0", "1.1")),
        ("php", "php", r"php license", ("3.0", "3.01")),
        ("python", "python", r"python(?: software foundation)? license", ("2.0",)),
        ("ruby", "ruby", r"ruby license", ()),
        ("perl", "perl", r"same terms as perl(?: itself)?", ()),
        ("odbl", "database", r"open (?:data commons open )?database license", ("1.0",)),
        ("odc-by", "data", r"open data commons attribution license", ("1.0",)),
        ("pddl", "data", r"(?:open data commons )?public domain dedication (?:and|&) license", ("1.0",)),
        ("cecill", "cecill", r"cecill(?: [abc])?", ("1.0", "2.0", "2.1")),
        ("ms-pl", "microsoft", r"microsoft public license", ()),
        ("ms-rl", "microsoft", r"microsoft reciprocal license", ()),
        ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)? license", ()),
        ("upl", "universal", r"universal permissive license", ("1.0",)),
        ("qpl", "q", r"q public license", ("1.0",)),
        ("ibm-pl", "ibm", r"ibm public license", ("1.0",)),
        ("npl", "netscape", r"netscape public license", ("1.0", "1.1")),
        ("sspl", "server", r"server side public license", ("1",)),
        ("bsl", "business", r"business source license", ("1.1",)),
        ("elastic", "elastic", r"elastic license", ("2.0",)),
        ("rail", "rail", r"(?:open )?rail(?: m)?(?: license)?", ()),
        ("openssl", "openssl", r"openssl license", ()),
        ("postgresql", "postgresql", r"postgresql license", ()),
        ("vim", "vim", r"vim license", ()),
        ("json", "json", r"json license", ()),
        ("beerware", "beer", r"beer ?ware(?: license)?", ()),
        ("w3c", "w3c", r"w3c(?: software)?(?: notice and)? license", ()),
        ("icu", "icu", r"icu license", ()),
        ("unicode", "unicode", r"unicode(?: data files and software)? license", ()),
    ):
        for v in versions:
            add(f"{label}-{v}-or-later", keyword, rf"{name} {_version(v)}{later}", 82)
            add(f"{label}-{v}", keyword, rf"{name} {_version(v)}", 75)
        if " " in name or name != label:
            add(label, keyword, name, 45)
    add("proprietary", "rights", r"all rights reserved", 10)
    add("proprietary", "proprietary", r"proprietary and confidential", 20)
    add("spdx", "spdx", r"spdx license identifier", 5)
    return tuple(rules)


#: Words are runs of letters, digits and non-ASCII characters; everything else separates them.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


class Scanner:
    """The compiled rules of one worker."""

    def __init__(self, rules: tuple[Rule, ...]):
        import ahocorasick

        self.rules = [(r.label, r.priority, re.compile(r.pattern)) for r in rules]
        by_word: dict[str, list[int]] = {}
        for i, r in enumerate(rules):
            by_word.setdefault(r.keyword, []).append(i)
        self.machine = ahocorasick.Automaton()
        for word, ids in by_word.items():
            self.machine.add_word(word, tuple(ids))
        self.machine.make_automaton()

    def detect(self, line: str) -> list[tuple[str, int, int, int]]:
        """(label, priority, start, end) of what remains; line: words with a space before, between and after."""
        ids = {i for _, group in self.machine.iter(line) for i in group}
        found = sorted(((p, m.start(), m.end(), label) for label, p, rx in (self.rules[i] for i in ids) for m in rx.finditer(line)), key=lambda x: (-x[0], x[1] - x[2], x[1], x[3]))
        kept: list[tuple[str, int, int, int]] = []
        # intervals of kept ones that lie in no other: their ends rise with their starts
        starts: list[int] = []
        ends: list[int] = []
        for p, a, b, label in found:
            i = bisect_right(starts, a)
            if i and ends[i - 1] >= b:
                continue
            kept.append((label, p, a, b))
            inner = slice(bisect_left(starts, a), bisect_right(ends, b))
            starts[inner], ends[inner] = [a], [b]
        return kept


def base_places(line: bytes) -> list[tuple[int, str]]:
    """(byte offset of the space before, label) of every place of a base phrase."""
    out = []
    for phrase, label in BASE:
        needle, at = b" " + phrase.encode() + b" ", -1
        while (at := line.find(needle, at + 1)) >= 0:
            out.append((at, label))
    return out


@lru_cache(maxsize=2)
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(rules)


def scan_text(text: str | None, machine: Scanner) -> dict:
    words = (text or "").encode().translate(_TABLE).split()
    line = b" " + b" ".join(words) + b" "
    places = sorted(base_places(line))
    found = machine.detect(line.decode())
    base = sorted({x for _, x in places})
    starts = [line.count(b" ", 0, at) for at in ((places[0][0], places[-1][0]) if places else ())]
    # a base label that a more exact one names (gpl, gpl-3.0) stays; the score is the best detection's priority as a share
    labels = sorted({x[0] for x in found} | set(base))
    score = max([p / 100 for _, p, _, _ in found] + [0.5] * bool(places), default=0.0)
    return {"n_words": len(words), "n_base": len(places), "first_word": starts[0] if places else None, "last_word": starts[1] if places else None, "base_labels": ",".join(base), "labels": ",".join(labels), "score": score, "spans": [(x[0], a, b) for x, a, b in ((x, x[2], x[3]) for x in found)]}


def scan(docs: DataFrame, rules: tuple[Rule, ...] | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_base, first_word, last_word, base_labels, labels, score, spans) of every row.

    spans: array of (label, start, end), offsets in the text's words joined by single spaces (with one before).
    """
    rules = build_rules() if rules is None else rules
    kind = dict(docs.dtypes)[key]
    schema = f"{key} {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label:string,start:int,end:int>>"
    fields = [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))]

    def run(batches):
        machine = scanner(rules)
        for b in batches:
            rows = [scan_text(t.as_py(), machine) for t in b.column(1)]
            cols = []
            for name, t in fields:
                values = [r[name] for r in rows]
                if name == "spans":
                    values = [[{"label": x, "start": i, "end": j} for x, i, j in v] for v in values]
                cols.append(pa.array(values, t))
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], [key, *[n for n, _ in fields]])

    ship(docs.sparkSession)
    return docs.select(key, text).mapInArrow(run, schema)
