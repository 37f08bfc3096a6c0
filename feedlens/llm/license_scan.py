"""License scan with ordered signature rules.

A rule is a regular expression over the normalised words of a text, with a
label, a keyword, a weight and its place in the order.  Texts pass a gate of a
few fixed words first; of the rules only those whose keyword stands in the text
are run.  Detections are intervals of words.  One is suppressed if the words it
claims lie within those of a detection of an earlier rule, or of any rule that
claims more words.  A detection claims the words that its rule names: all of them,
or the fixed part of a rule with a gap (the name after ``copyright ...``), so that
a license in the gap keeps its label.  Base phrases come first in the order and always keep their labels.

Everything happens within the row of a document: no join and no shuffle.
DataFrame functions only.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm.frames import ascii_lower

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Every rule's pattern holds one of these, so texts without them are left out.
GATE = ("licen", "hereby granted", "copyright", "gpl", "public domain", "cc by", "cc0", "creative commons", "rights reserved", "copyleft")

# Fixed values of the contract: phrase and label.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    pattern: str
    weight: float
    base: bool = False
    #: What a match claims, as a pattern at its end; by default what stands before the first gap.
    claim: str = ""


#: Where a pattern passes over words that it does not name.
_GAP = re.compile(r" ?\[a-z(?:0-9)? \]\{")


def _claim(rule: Rule) -> str:
    """Pattern of the part of a match that the rule claims, empty for all of it."""
    if rule.claim:
        return rf"(?<![^ ])(?:{rule.claim})$"
    return rf"^(?:{_GAP.split(rule.pattern)[0]})" if _GAP.search(rule.pattern) else ""


def _named(label: str, keyword: str, name: str, spdx: str | None = None) -> list[Rule]:
    """The ways in which a text can say that a license with this name holds."""
    lead = r"(?:released|distributed|available|provided|published|covered|offered|dual licen[sc]ed|made available|sublicen[sc]ed)"
    grant = r"(?:under|by|with|according to|pursuant to|subject to|in accordance with|governed by|as per)"
    terms = r"(?:the |a |an )?(?:terms (?:and conditions )?of )?(?:the |either the )?"
    said = re.sub(r"\(\?:[^()]*\)\?", "", name).replace("[sc]", "s")
    known = any(g in said for g in GATE)  # else the word license must follow
    rules = [
        Rule(label, keyword, rf"licen[sc]ed {grant} {terms}{name}(?: licen[sc]e)?", 0.95),
        Rule(label, keyword, rf"{lead} {grant} {terms}{name}" + ("(?: licen[sc]e)?" if known else " licen[sc]e"), 0.95),
        Rule(label, keyword, rf"{grant} {terms}{name} licen[sc]e", 0.9),
        Rule(label, keyword, rf"licen[sc]e (?:is |name |type |identifier |this is )?(?:the )?{name}", 0.8),
        Rule(label, keyword, rf"{name} (?:software |public |open source |document )?licen[sc]e", 0.75),
        Rule(label, keyword, rf"copyright [a-z0-9 ]{{1,80}}? {name}", 0.5, claim=name),
    ]
    if known:
        rules.append(Rule(label, keyword, name, 0.6))
    if spdx:
        rules.insert(0, Rule(label, "spdx", rf"spdx licen[sc]e identifier {spdx}", 1.0))
    return rules


def _texts() -> list[Rule]:
    """Sentences of licenses themselves."""
    return [
        Rule("mit", "hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy(?: of this software)?[a-z ]{0,60}? (?:copyright|licen[sc]e|software)(?: notice)?", 0.9),
        Rule("mit", "copyright notice", r"the above copyright notice and this permission notice shall be included", 0.9),
        Rule("isc", "with or without fee", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice", 0.95),
        Rule("bsd", "redistributions", r"redistributions (?:of source code|in binary form) must (?:retain|reproduce) the above copyright notice", 0.9),
        Rule("bsd-3", "endorse", r"neither the name of [a-z0-9 ]{1,80}? copyright holder[a-z ]{0,40}? endorse or promote", 0.9),
        Rule("apache-2", "apache", r"you may not use this file except in compliance with the licen[sc]e you may obtain a copy of the licen[sc]e at http www apache org licenses license 2 0", 1.0),
        Rule("apache-2", "apache", r"(?:http|https) www apache org licenses license 2 0", 0.95),
        Rule("gpl-2", "general public", r"gnu general public license as published by the free software foundation either version 2 of the license", 1.0),
        Rule("gpl-3", "general public", r"gnu general public license as published by the free software foundation either version 3 of the license", 1.0),
        Rule("lgpl-2.1", "lesser general public", r"gnu lesser general public license as published by the free software foundation either version 2 1 of the license", 1.0),
        Rule("lgpl-3", "lesser general public", r"gnu lesser general public license as published by the free software foundation either version 3 of the license", 1.0),
        Rule("agpl-3", "affero", r"gnu affero general public license as published by the free software foundation either version 3 of the license", 1.0),
        Rule("mpl-2", "mozilla", r"this source code form is subject to the terms of the mozilla public license v 2 0", 1.0),
        Rule("epl-2", "eclipse", r"made available under the terms of the eclipse public license 2 0", 1.0),
        Rule("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain", 1.0),
        Rule("wtfpl", "what the", r"do what the f[a-z]* you want to public license", 1.0),
        Rule("zlib", "misrepresented", r"the origin of this software must not be misrepresented[a-z ]{0,200}? licen[sc]e", 0.9),
        Rule("boost-1", "boost", r"boost software license version 1 0", 1.0),
        Rule("public-domain", "public domain", r"(?:dedicated|released|placed|donated) (?:in|to|into) the public domain", 0.9),
        Rule("public-domain", "public domain", r"(?:is|are) in the public domain", 0.7),
        Rule("cc0", "cc0", r"cc0(?: 1 0)?(?: universal)?", 0.8),
        Rule("cc0", "no rights reserved", r"no rights reserved", 0.8),
        Rule("creative-commons", "some rights reserved", r"some rights reserved", 0.5),
        Rule("all-rights-reserved", "all rights reserved", r"all rights reserved", 0.6),
        Rule("proprietary", "licen", r"(?:proprietary|commercial|closed source) licen[sc]e(?: agreement)?", 0.7),
        Rule("proprietary", "confidential", r"confidential and proprietary[a-z ]{0,60}? (?:copyright|licen[sc]e|rights reserved)", 0.7),
        Rule("copyright", "copyright", r"copyright (?:c )?(?:19|20)[0-9]{2}(?: (?:19|20)?[0-9]{2})?", 0.3),
        Rule("copyleft", "copyleft", r"copyleft(?: licen[sc]e)?", 0.4),
    ]


def _version(v: str) -> str:
    """A version as texts write it: 'version 2', 'v2 0', '2 0'."""
    major, _, minor = v.partition(".")
    tail = f"(?: {minor})" if minor not in ("", "0") else "(?: 0)?"
    return rf"(?:(?:version|v|ver|rev) ?)?{major}{tail}(?: or (?:any )?later(?: version)?| only)?"


#: Names of licenses: label, keyword, name, versions (None: without a version).
_FAMILIES = (
    ("agpl", "affero", r"(?:gnu )?affero (?:general public licen[sc]e|gpl)", ("1.0", "3.0", None)),
    ("agpl", "agpl", r"(?:gnu )?agpl", ("3.0", None)),
    ("lgpl", "lesser general public", r"(?:gnu )?lesser general public licen[sc]e", ("2.1", "3.0", None)),
    ("lgpl", "library general public", r"(?:gnu )?library general public licen[sc]e", ("2.0", None)),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl", ("2.0", "2.1", "3.0", None)),
    ("gpl", "general public", r"(?:gnu )?general public licen[sc]e", ("1.0", "2.0", "3.0", None)),
    ("gpl", "gpl", r"(?:gnu )?gpl", ("2.0", "3.0", None)),
    ("gfdl", "free documentation", r"(?:gnu )?free documentation licen[sc]e", ("1.2", "1.3", None)),
    ("apache", "apache", r"apache(?: software)?(?: licen[sc]e)?", ("1.1", "2.0", None)),
    ("mpl", "mozilla", r"mozilla public licen[sc]e", ("1.1", "2.0", None)),
    ("epl", "eclipse", r"eclipse public licen[sc]e", ("1.0", "2.0", None)),
    ("eupl", "european union public", r"european union public licen[sc]e", ("1.1", "1.2", None)),
    ("cddl", "common development", r"common development and distribution licen[sc]e", ("1.0", "1.1", None)),
    ("cpl", "common public", r"common public licen[sc]e", ("1.0", None)),
    ("afl", "academic free", r"academic free licen[sc]e", ("3.0", None)),
    ("osl", "open software", r"open software licen[sc]e", ("3.0", None)),
    ("artistic", "artistic", r"artistic licen[sc]e", ("1.0", "2.0", None)),
    ("ofl", "open font", r"(?:sil )?open font licen[sc]e", ("1.1", None)),
    ("odbl", "open database", r"open database licen[sc]e", ("1.0", None)),
    ("bsd-2", "bsd", r"(?:simplified bsd|freebsd|bsd 2 clause|2 clause bsd|two clause bsd)", (None,)),
    ("bsd-3", "bsd", r"(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd|three clause bsd)", (None,)),
    ("bsd-4", "bsd", r"(?:original bsd|bsd 4 clause|4 clause bsd|four clause bsd)", (None,)),
    ("bsd", "bsd", r"bsd(?: style)?", (None,)),
    ("mit", "mit", r"(?:mit|mit x11)", (None,)),
    ("mit", "x11", r"x11", (None,)),
    ("mit", "expat", r"expat", (None,)),
    ("isc", "isc", r"isc", (None,)),
    ("zlib", "zlib", r"zlib(?: libpng)?", (None,)),
    ("boost", "boost", r"boost software licen[sc]e", ("1.0", None)),
    ("python", "python software foundation", r"python software foundation licen[sc]e", ("2.0", None)),
    ("unlicense", "unlicense", r"unlicense", (None,)),
    ("wtfpl", "wtfpl", r"wtfpl", (None,)),
    ("beerware", "beerware", r"beerware", (None,)),
    ("cc-by-nc-sa", "cc by", r"(?:creative commons )?cc by nc sa", ("2.0", "3.0", "4.0", None)),
    ("cc-by-nc-nd", "cc by", r"(?:creative commons )?cc by nc nd", ("2.0", "3.0", "4.0", None)),
    ("cc-by-nc", "cc by", r"(?:creative commons )?cc by nc", ("2.0", "3.0", "4.0", None)),
    ("cc-by-sa", "cc by", r"(?:creative commons )?cc by sa", ("2.0", "3.0", "4.0", None)),
    ("cc-by-nd", "cc by", r"(?:creative commons )?cc by nd", ("2.0", "3.0", "4.0", None)),
    ("cc-by", "cc by", r"(?:creative commons )?cc by", ("2.0", "3.0", "4.0", None)),
    ("cc-by-nc-sa", "creative commons", r"creative commons attribution non ?commercial share ?alike", ("3.0", "4.0", None)),
    ("cc-by-nc-nd", "creative commons", r"creative commons attribution non ?commercial no ?deriv(?:ative|ativ)e?s?(?: works)?", ("3.0", "4.0", None)),
    ("cc-by-nc", "creative commons", r"creative commons attribution non ?commercial", ("3.0", "4.0", None)),
    ("cc-by-sa", "creative commons", r"creative commons attribution share ?alike", ("3.0", "4.0", None)),
    ("cc-by-nd", "creative commons", r"creative commons attribution no ?deriv(?:ative|ativ)e?s?(?: works)?", ("3.0", "4.0", None)),
    ("cc-by", "creative commons", r"creative commons attribution", ("3.0", "4.0", None)),
    ("creative-commons", "creative commons", r"creative commons", (None,)),
)


def _build() -> tuple[Rule, ...]:
    rules = [Rule(label, phrase, phrase, 1.0, base=True) for phrase, label in BASE] + _texts()
    for label, keyword, name, versions in _FAMILIES:
        for v in versions:
            full = f"{label}-{v.removesuffix('.0')}" if v and not label.startswith("cc-") else label
            version = rf"(?: licen[sc]e)? {_version(v)}" if v else ""
            spdx = label.replace("-", " ") + (rf"(?: {v.replace('.', ' ')})(?: only| or later)?" if v else "")
            rules += _named(full, keyword, name + version, spdx)
    return tuple(dict.fromkeys(rules))


RULES = _build()


def _spaces(part: Column) -> Column:
    return F.length(part) - F.length(F.replace(part, F.lit(" "), F.lit("")))


def _places(words: Column, pattern: Column, claim: Column) -> Column:
    """First and last word of each match of a pattern, from 0, and of what it claims."""
    found, parts = F.regexp_extract_all(words, pattern, F.lit(0)), F.split(words, pattern)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<first:int,last:int,from:int,to:int>>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        first = s["at"] + _spaces(x["part"])
        last = first + _spaces(x["found"])
        begin = first + F.when(claim == "", 0).otherwise(_spaces(F.split(x["found"], claim, 2)[0]))
        end = F.when(claim == "", last).otherwise(begin + _spaces(F.regexp_substr(x["found"], claim)))
        place = F.struct(first.alias("first"), last.alias("last"), begin.alias("from"), end.alias("to"))
        return F.struct(last.alias("at"), F.concat(s["out"], F.array(place)).alias("out"))

    pairs = F.filter(F.arrays_zip(found.alias("found"), parts.alias("part")), lambda x: x["found"].isNotNull())
    return F.aggregate(pairs, start, step, lambda s: s["out"])


def _rules(rules: tuple[Rule, ...]) -> Column:
    """The rules in their order as one constant array."""
    rows = [
        {"rank": i, "label": r.label, "keyword": r.keyword, "pattern": rf"(?<![^ ])(?:{r.pattern})(?![^ ])", "weight": r.weight, "base": r.base, "claim": _claim(r)}
        for i, r in enumerate(rules)
    ]
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<rank:int,label:string,keyword:string,pattern:string,weight:double,base:boolean,claim:string>>")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words`` and ``detections``, the
    surviving detections as an array of (rank, label, weight, base, first, last)
    in the order of their first words.

    Only A-Z are lowered; words are runs of a-z, 0-9 and characters beyond
    ASCII.  A null text is empty.  Rows that repeat a doc_id are scanned each on
    its own.  Other columns are ignored.  A base detection is never suppressed."""
    words = F.trim(F.regexp_replace(ascii_lower(F.coalesce(F.col(text), F.lit(""))), NOT_WORD, " "))
    out = docs.select(F.col(doc_id).alias("__doc"), words.alias("__words"))
    gate = F.lit(False)
    for word in GATE:
        gate = gate | F.contains(F.col("__words"), F.lit(word))
    near = F.filter(_rules(rules), lambda r: F.contains(F.col("__words"), r["keyword"]) & F.rlike(F.col("__words"), r["pattern"]))
    found = F.flatten(
        F.transform(
            near,
            lambda r: F.transform(
                _places(F.col("__words"), r["pattern"], r["claim"]),
                lambda p: F.struct(
                    *[p[c].alias(c) for c in ("first", "last")], *[r[c].alias(c) for c in ("rank", "label", "weight", "base")], *[p[c].alias(c) for c in ("from", "to")]
                ),
            ),
        )
    )
    none = F.array().cast("array<struct<first:int,last:int,rank:int,label:string,weight:double,base:boolean,from:int,to:int>>")
    out = out.select(
        F.col("__doc").alias(doc_id),
        F.when(F.col("__words") == "", 0).otherwise(_spaces(F.col("__words")) + 1).cast("long").alias("n_words"),
        F.when(gate, found).otherwise(none).alias("__found"),
    )

    def beaten(x: Column) -> Column:
        within = lambda y: (y["from"] <= x["from"]) & (y["to"] >= x["to"])
        longer = lambda y: y["to"] - y["from"] > x["to"] - x["from"]
        return F.exists("__found", lambda y: within(y) & ((y["rank"] < x["rank"]) | longer(y)))

    left = F.transform(F.filter("__found", lambda x: x["base"] | ~beaten(x)), lambda x: x.dropFields("from", "to"))
    return out.withColumn("detections", F.array_sort(left)).drop("__found")


def summary(scanned: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Counts, labels and the highest weight of each scanned document."""
    base = F.filter("detections", lambda x: x["base"])
    names = lambda part: F.array_join(F.sort_array(F.array_distinct(F.transform(part, lambda x: x["label"]))), ",")
    return scanned.select(
        doc_id,
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda x: x["first"])).cast("long").alias("first_word"),
        F.array_max(F.transform(base, lambda x: x["first"])).cast("long").alias("last_word"),
        names(base).alias("base_labels"),
        names(F.col("detections")).alias("labels"),
        F.coalesce(F.array_max(F.transform("detections", lambda x: x["weight"])), F.lit(0.0)).alias("score"),
    )
