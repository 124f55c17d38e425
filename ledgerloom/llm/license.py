"""License scans: ordered rules behind keywords, with contained detections suppressed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import or_empty
from ledgerloom.llm.scans import let, running, sums_before

# Places where these words stand one after another always count.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Everything between words; words are ASCII letters and digits and all other characters.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Label, name as a pattern over lower-case words between single spaces, a keyword that
# every such name holds, and versions.
FAMILIES = (
    ("mit", "(?:mit|expat) license", "license", ()),
    ("mit-0", "mit no attribution(?: license)?", "mit no attribution", ()),
    ("apache", "apache (?:software )?license", "apache", ("1.0", "1.1", "2.0")),
    ("gpl", "(?:gnu )?general public license", "general public license", ("1.0", "2.0", "3.0")),
    ("gpl", "(?:gnu )?gpl", "gpl", ("1.0", "2.0", "3.0")),
    ("lgpl", "(?:gnu )?(?:lesser|library) general public license", "general public license", ("2.0", "2.1", "3.0")),
    ("lgpl", "(?:gnu )?lgpl", "lgpl", ("2.0", "2.1", "3.0")),
    ("agpl", "(?:gnu )?affero general public license", "affero", ("1.0", "3.0")),
    ("agpl", "(?:gnu )?agpl", "agpl", ("1.0", "3.0")),
    ("gfdl", "(?:gnu )?free documentation license", "free documentation", ("1.1", "1.2", "1.3")),
    ("mpl", "mozilla public license", "mozilla", ("1.0", "1.1", "2.0")),
    ("epl", "eclipse public license", "eclipse", ("1.0", "2.0")),
    ("cpl", "common public license", "common public", ("1.0",)),
    ("ipl", "ibm public license", "ibm public", ("1.0",)),
    ("cddl", "common development and distribution license", "common development", ("1.0", "1.1")),
    ("bsd-2-clause", "(?:simplified bsd|freebsd|bsd 2 clause)(?: license)?", "bsd", ()),
    ("bsd-3-clause", "(?:new bsd|modified bsd|bsd 3 clause)(?: license)?", "bsd", ()),
    ("bsd-4-clause", "(?:original bsd|bsd 4 clause)(?: license)?", "bsd", ()),
    ("bsd", "bsd (?:style )?license", "bsd", ()),
    ("isc", "isc license", "isc license", ()),
    ("zlib", "zlib(?: libpng)? license", "zlib", ()),
    ("unlicense", "(?:the )?unlicense", "unlicense", ()),
    ("wtfpl", "wtfpl", "wtfpl", ("1.0", "2.0")),
    ("wtfpl", "do what the fuck you want to public license", "do what the", ()),
    ("cc0", "cc0", "cc0", ("1.0",)),
    ("cc0", "creative commons zero", "creative commons", ("1.0",)),
    ("cc-by-sa", "cc by sa", "cc by", ("2.0", "2.5", "3.0", "4.0")),
    ("cc-by-sa", "creative commons attribution share ?alike(?: license)?", "creative commons", ("3.0", "4.0")),
    ("cc-by-nc", "cc by nc", "cc by", ("2.0", "3.0", "4.0")),
    ("cc-by-nc", "creative commons attribution non ?commercial(?: license)?", "creative commons", ("3.0", "4.0")),
    ("cc-by-nd", "cc by nd", "cc by", ("2.0", "3.0", "4.0")),
    ("cc-by-nd", "creative commons attribution no ?derivatives(?: license)?", "creative commons", ("3.0", "4.0")),
    ("cc-by", "cc by", "cc by", ("2.0", "2.5", "3.0", "4.0")),
    ("cc-by", "creative commons attribution(?: license)?", "creative commons", ("3.0", "4.0")),
    ("artistic", "artistic license", "artistic", ("1.0", "2.0")),
    ("bsl", "boost software license", "boost", ("1.0",)),
    ("psf", "python software foundation license", "python", ("2.0",)),
    ("php", "php license", "php license", ("3.0", "3.01")),
    ("postgresql", "postgresql licen[sc]e", "postgresql", ()),
    ("openssl", "openssl license", "openssl", ()),
    ("eupl", "eupl", "eupl", ("1.0", "1.1", "1.2")),
    ("eupl", "european union public licen[sc]e", "european union", ("1.0", "1.1", "1.2")),
    ("osl", "open software license", "open software", ("1.0", "2.0", "2.1", "3.0")),
    ("afl", "academic free license", "academic free", ("1.1", "2.0", "2.1", "3.0")),
    ("ms-pl", "microsoft public license", "microsoft", ()),
    ("ms-rl", "microsoft reciprocal license", "microsoft", ()),
    ("cecill", "cecill(?: free software)?(?: license)?", "cecill", ("1.0", "2.0", "2.1")),
    ("ofl", "(?:sil )?open font license", "open font", ("1.0", "1.1")),
    ("odbl", "open (?:data commons open )?database license", "database license", ("1.0",)),
    ("pddl", "public domain dedication and license", "public domain", ("1.0",)),
    ("ncsa", "(?:university of illinois )?ncsa(?: open source)? license", "ncsa", ()),
    ("zpl", "zope public license", "zope", ("2.0", "2.1")),
    ("lppl", "latex project public license", "latex project", ("1.2", "1.3")),
    ("upl", "universal permissive license", "universal permissive", ("1.0",)),
    ("busl", "business source license", "business source", ("1.1",)),
    ("sspl", "server side public license", "server side", ("1.0",)),
    ("elastic", "elastic license", "elastic", ("2.0",)),
    ("qpl", "q public license", "q public", ("1.0",)),
    ("mulanpsl", "mulan permissive software license", "mulan", ("1.0", "2.0")),
    ("vim", "vim license", "vim license", ()),
    ("x11", "x11 license", "x11", ()),
    ("beerware", "beer ?ware license", "beer", ()),
)
# Label, words of a notice or an address, and a keyword of it.
NOTICES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "hereby granted"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", "permission to use"),
    ("bsd", "redistribution and use in source and binary forms(?: with or without modification)?", "redistribution"),
    ("bsd-3-clause", "may be used to endorse or promote products(?: derived from (?:this software|it))?", "endorse or promote"),
    ("gpl", "this (?:program|library) is free software you can redistribute it and or modify it", "free software"),
    ("apache-2.0", "you may not use this file except in compliance with the license", "in compliance"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered"),
    ("zlib", "this software is provided as is without any express or implied warranty", "express or implied"),
    ("public-domain", "(?:released|placed|dedicated) (?:in|into|to) the public domain", "public domain"),
    ("proprietary", "all rights reserved", "all rights reserved"),
    ("proprietary", "(?:proprietary and confidential|confidential and proprietary)", "proprietary"),
    ("apache-2.0", "apache org licenses license 2 0", "apache org"),
    ("mit", "opensource org licenses? mit", "opensource org"),
    ("bsd-3-clause", "opensource org licenses? bsd 3 clause", "opensource org"),
    ("bsd-2-clause", "opensource org licenses? bsd 2 clause", "opensource org"),
    ("gpl", "gnu org (?:licenses|copyleft) gpl", "gnu org"),
    ("lgpl", "gnu org (?:licenses|copyleft) lgpl", "gnu org"),
    ("agpl", "gnu org licenses agpl", "gnu org"),
    ("mpl-2.0", "mozilla org mpl 2 0", "mozilla org"),
    ("cc-by", "creativecommons org licenses by", "creativecommons"),
    ("cc-by-sa", "creativecommons org licenses by sa", "creativecommons"),
    ("cc0", "creativecommons org publicdomain zero", "creativecommons"),
    ("mit", "to deal in the software without restriction", "deal in the software"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies", "permission notice"),
    ("mit", "the software is provided as is without warranty of any kind express or implied", "without warranty"),
    ("isc", "the software is provided as is and the author disclaims all warranties", "disclaims all warranties"),
    ("isc", "provided that the above copyright notice and this permission notice appear in all copies", "permission notice"),
    ("bsd", "redistributions of source code must retain the above copyright notice", "above copyright notice"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice", "above copyright notice"),
    ("bsd", "this software is provided by the (?:copyright holders?|regents|authors?) and contributors as is", "and contributors"),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software", "advertising materials"),
    ("apache-1.1", "must not be used to endorse or promote products", "endorse or promote"),
    ("apache-2.0", "software distributed under the license is distributed on an as is basis", "as is basis"),
    ("apache-2.0", "without warranties or conditions of any kind either express or implied", "conditions of any kind"),
    ("gpl", "this (?:program|library) is free software", "free software"),
    ("gpl", "either version [123] of the license or at your option any later version", "any later version"),
    ("gpl", "without even the implied warranty of merchantability or fitness for a particular purpose", "implied warranty"),
    ("gpl", "you should have received a copy of the gnu general public license", "should have received"),
    ("lgpl", "either version 2 1 of the license or at your option any later version", "any later version"),
    ("lgpl", "you should have received a copy of the gnu (?:lesser|library) general public license", "should have received"),
    ("agpl", "you should have received a copy of the gnu affero general public license", "should have received"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license", "source code form"),
    ("mpl-1.1", "the contents of this file are subject to the mozilla public license version", "contents of this file"),
    ("cddl", "the contents of this file are subject to the terms of the common development", "contents of this file"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse", "accompanying materials"),
    ("bsl-1.0", "free of charge to any person or organization obtaining a copy", "person or organization"),
    ("bsl-1.0", "boost org license 1 0", "boost org"),
    ("zlib", "the origin of this software must not be misrepresented", "misrepresented"),
    ("zlib", "altered source versions must be plainly marked as such", "plainly marked"),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software", "anyone is free"),
    ("cc0", "has waived all copyright and related or neighboring rights", "waived all"),
    ("cc-by", "you are free to share copy and redistribute the material in any medium or format", "free to share"),
    ("ofl", "with reserved font name", "reserved font name"),
    ("artistic", "state the conditions under which a package may be copied", "conditions under which"),
    ("postgresql", "permission to use copy modify and distribute this software and its documentation", "permission to use"),
    ("openssl", "this product includes software developed by the openssl project", "openssl"),
    ("x11", "in advertising or otherwise to promote the sale use or other dealings in this software", "other dealings"),
    ("proprietary", "unauthorized copying of this file via any medium is strictly prohibited", "unauthorized copying"),
)


@dataclass(frozen=True)
class Rule:
    """A pattern over words, looked for only in texts with the keyword; a higher priority wins."""

    name: str
    label: str
    pattern: str
    keyword: str
    priority: int
    confidence: float


PRIORITIES = 6
_GRANT = (
    "(?:licen[sc]ed|released|distributed|available|published|provided|covered|offered|dual licensed)"
    " under (?:the )?(?:terms of (?:the )?)?"
)
_LATER = "(?: or (?:any )?later(?: version)?| only)?"


def rules() -> list[Rule]:
    """Every family's tag, grant and title with each of its versions and without, and the notices."""
    found = []

    def add(label: str, form: str, pattern: str, keyword: str, priority: int, confidence: float) -> None:
        found.append(Rule(f"{len(found):03d}-{label}-{form}", label, pattern, keyword, priority, confidence))

    for label, name, keyword, versions in FAMILIES:
        for version in versions:
            major, minor = version.split(".")
            number = f"(?:version |v ?)?{major}{f'(?: {minor})?' if minor == '0' else f' {minor}'}{_LATER}"
            whole = f"{label}-{version}"
            add(whole, "tag", f"spdx license identifier {_words(whole)}{_LATER}", "spdx", 5, 1.0)
            add(whole, "grant", f"{_GRANT}{name} {number}", keyword, 4, 0.95)
            add(whole, "title", f"{name} {number}", keyword, 3, 0.85)
        add(label, "tag", f"spdx license identifier {_words(label)}", "spdx", 5, 1.0)
        add(label, "grant", f"{_GRANT}{name}", keyword, 4, 0.9)
        add(label, "title", name, keyword, 1, 0.6)
    for label, pattern, keyword in NOTICES:
        add(label, "notice", pattern, keyword, 2, 0.8)
    return found


def _words(label: str) -> str:
    return label.replace("-", " ").replace(".", " ")


RULES = rules()
# One of these is in every text that a rule can match; a test holds the rules against it.
GATE = (
    r"licen[sc]e|spdx|gpl|bsd|creative ?commons|cc by|cc0|eupl|cecill|wtfpl|mit no attr"
    r"|(?:gnu|apache|opensource|mozilla|boost) org|rights reserved|proprietary|public domain|permission|redistribut"
    r"|free software|in compliance|unencumbered|express or implied|endorse or promote|copyright|warrant"
    r"|deal in the software|and contributors|advertising|any later version|source code form|as is basis"
    r"|conditions|misrepresented|plainly marked|anyone is free|waived all|free to share|font name"
    r"|openssl|person or organization|contents of this file|accompanying materials|unauthorized copying"
)


def normal(text: Column) -> Column:
    """The words of a text, ASCII letters in lower case, with one space around each."""
    words = F.trim(F.regexp_replace(text, BETWEEN, " "))
    lower = F.translate(words, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.concat(F.lit(" "), lower, F.lit(" "))


def _spaces(text: Column) -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, F.lit(" "), F.lit("")))


def _located(words: Column, pattern: Column) -> Column:
    """Where a pattern over whole words matches: ``start`` and ``end`` (exclusive), as word numbers."""
    whole = F.concat(F.lit("(?<= )(?:"), pattern, F.lit(")(?= )"))
    parts = F.arrays_zip(
        F.split(words, whole, -1).alias("gap"), F.regexp_extract_all(words, whole, F.lit(0)).alias("found")
    )

    def spans(parts: Column) -> Column:
        gaps = F.transform(parts, lambda part: _spaces(part["gap"]))
        words_in = F.transform(parts, lambda part: _spaces(part["found"]))
        return let(F.arrays_zip(gaps.alias("gap"), words_in.alias("found")), placed)

    def placed(parts: Column) -> Column:
        before = sums_before(F.transform(parts, lambda part: part["gap"] + part["found"]))
        return F.transform(
            F.arrays_zip(before.alias("at"), parts.alias("part")),
            lambda one: F.struct(
                (one["at"] + one["part"]["gap"] - 1).alias("start"),
                (one["at"] + one["part"]["gap"] + one["part"]["found"]).alias("end"),
            ),
        )

    return let(F.filter(parts, lambda part: part["found"].isNotNull()), spans)


DETECTIONS = "array<struct<start: int, end: int, label: string, rule: string, priority: int, confidence: double>>"


def base_places(words: Column) -> Column:
    """Places of the base phrases: ``start`` and ``label``."""

    def labelled(phrase: str, label: str) -> Column:
        starts = _located(words, F.lit(phrase))
        return F.transform(starts, lambda span: F.struct(span["start"].alias("start"), F.lit(label).alias("label")))

    places = [labelled(phrase, label) for phrase, label in BASE.items()]
    empty = F.expr("cast(array() as array<struct<start: int, label: string>>)")
    return F.when(words.contains("license"), F.concat(*places)).otherwise(empty)


def detections(words: Column) -> Column:
    """What the rules find in normal words, without what is contained in a detection of the same or
    a higher priority; of equal spans the highest priority stays."""
    table = F.array(
        *[
            F.struct(
                F.lit(r.keyword).alias("keyword"),
                F.lit(r.pattern).alias("pattern"),
                F.lit(r.label).alias("label"),
                F.lit(r.name).alias("rule"),
                F.lit(r.priority).alias("priority"),
                F.lit(r.confidence).alias("confidence"),
            )
            for r in RULES
        ]
    )

    def apply(rule: Column) -> Column:
        def describe(span: Column) -> Column:
            return F.struct(
                span["start"].alias("start"),
                (-span["end"]).alias("back"),
                (-rule["priority"]).alias("rank"),
                rule["rule"].alias("rule"),
                span["end"].alias("end"),
                rule["label"].alias("label"),
                rule["priority"].alias("priority"),
                rule["confidence"].alias("confidence"),
            )

        return F.transform(_located(words, rule["pattern"]), describe)

    found = F.flatten(F.transform(F.filter(table, lambda rule: F.contains(words, rule["keyword"])), apply))

    # From left to right, the longest and highest first; reach[p] is how far a detection of
    # priority p or higher extends that began before.
    def add(reach: Column, span: Column) -> Column:
        return F.transform(
            reach, lambda end, p: F.when(p <= span["priority"], F.greatest(end, span["end"])).otherwise(end)
        )

    def further(reach: Column, more: Column) -> Column:
        return F.zip_with(reach, more, lambda a, b: F.greatest(a, b))

    def covered(reach: Column, span: Column) -> Column:
        return F.element_at(reach, span["priority"] + 1) >= span["end"]

    def uncovered(spans: Column) -> Column:
        zero = F.array_repeat(F.lit(0), PRIORITIES)
        hidden = running(spans, "boolean", zero, add, further, "array<int>", covered)
        left = F.filter(F.arrays_zip(spans.alias("span"), hidden.alias("hidden")), lambda one: ~one["hidden"])
        names = ("start", "end", "label", "rule", "priority", "confidence")
        return F.transform(left, lambda one: F.struct(*[one["span"][name].alias(name) for name in names]))

    kept = let(F.array_sort(found), uncovered)
    return F.when(words.rlike(GATE), kept).otherwise(F.expr(f"cast(array() as {DETECTIONS})"))


def scan(documents: DataFrame) -> DataFrame:
    """``documents`` with ``n_words``, ``base`` (``start``, ``label``) and ``detections``.

    Null and empty texts have no words and no places. Every row is looked at by itself, repeated
    ones too; an empty table stays empty; columns of these names are replaced. Texts are read whole, and
    the time a text takes grows with its length and its places, not with their square.
    """
    found = {
        "n_words": F.when(F.char_length("words") <= 2, 0).otherwise(_spaces(F.col("words")) - 1),
        "base": base_places(F.col("words")),
        "detections": detections(F.col("words")),
    }
    # A row travels as one column, so that its columns' names meet no others.
    rows = documents.select(F.struct("*").alias("row"), normal(or_empty(F.col("text"))).alias("words"))
    stay = [F.col("row").getField(name).alias(name) for name in documents.columns if name not in found]
    return rows.select(*stay, *[column.alias(name) for name, column in found.items()])


def certainty(found: Column) -> Column:
    """From 0 to 1: how sure it is that one of the detections is right."""
    return F.lit(1.0) - F.aggregate(found, F.lit(1.0), lambda done, span: done * (1.0 - span["confidence"]))
