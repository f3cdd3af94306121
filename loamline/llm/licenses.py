"""Problem 2: the licence of every file and repository.

Texts are normalized (comment marks, list marks, copyright notices, punctuation, spelling variants go), cut into units, and
the units' hashes are equi-joined with the hashes of templates that went through the same normalization. Templates are of two
kinds. Bodies: the operative sentences of licence texts and of the notices that go into files; a licence is stated if all its
sentences are there, whatever stands around them, its name or not. Names: canonical words made from the table of known
licences; only names in a stating position count: after a granting frame ("under", "License:", an SPDX tag, ...) or alone in
their sentence; not what a sentence mentions, negates or puts into the past. Names go before bodies. Files inherit what the
files of the root directory of their repository state. What no template matches is no evidence.

Distinct texts are normalized and joined once, by their hashes, however many files carry them; common and missing texts are
dealt over SALTS tasks where files meet them.

Cases: null, empty and unmatched texts are no evidence; null paths and repositories form groups of their own and are no
root files; repeated rows count once; rows of one file that state different licences are joined by ' AND '.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Spelling variants of names and versions, applied in this order to lower-case text.
VARIANTS = (
    (r"licen[cs]e[sd]?|lizenz|licence|licenza|licencia|licen[cç]a|licentie", "license"),
    (r"\b(?:and |but )?no (?:later|other|newer) versions?\b", " only "),
    (r"\bor[- ](?:any |\(at your option\) any )?(?:later|newer)(?: versions?)?\b|(?<=\d)\+", " later "),
    (r"\bthree\b", "3"),
    (r"\btwo\b", "2"),
    (r"\bclauses\b", "clause"),
    (r"\b(?:new|revised|modified) bsd\b", "bsd 3 clause"),
    (r"\b(?:simplified|freebsd) bsd\b|\bfreebsd\b", "bsd 2 clause"),
    (r"\blesser (?:general public|gpl)\b", "lgpl"),
    (r"\baffero (?:general public|gpl)\b", "agpl"),
    (r"\bgeneral public\b", "gpl"),
    (r"\b([al]?gpl)v(?=\d)", r"\1 "),
    (r"\bmozilla public\b", "mpl"),
    (r"\basl\b", "apache"),
    (r"\bcreative commons zero\b|\bcc zero\b", "cc 0"),
    (r"\bcc0\b", "cc 0"),
    (r"\bcreative commons\b", "cc"),
    (r"\battribution\b", "by"),
    (r"\bnon[- ]?commercial\b", "nc"),
)
# Words of names that tell licences apart, and words that names contain besides.
NAME_WORDS = frozenset("mit apache bsd clause gpl lgpl agpl mpl isc unlicense cc by nc only later".split())
FILLERS = frozenset("the a license terms version v known as in of with gnu public software international universal foundation unported generic".split())
# Names that the table's ids and titles do not yield; the deprecated ids without suffix mean "only".
EXTRA = {"gpl 3": "GPL-3.0-only", "gpl 2": "GPL-2.0-only", "agpl 3": "AGPL-3.0-only", "cc 0": "CC0-1.0"}
# Frames before a name that state it (also in other languages), and words before a name that do not.
GRANT = re.compile(
    r"\b(?:under|identifier|subject to|as far as|governed by|unter|sous|soumis (?:à|a)|bajo|sotto|sob|onder|according to|terms of|license is|licensed)\b|@license|\b(?:license|terms)\s*[:=]|под|лицензи|許諾|许可|ライセンス"
)
DENIAL = re.compile(
    r"\b(?:mentions?|mentioned|mentioning|was|were|had been|earlier|formerly|previously|originally|not|never|neither|unlike|incompatible|instead of|rather than|no longer|until|whose)\b"
)
#: These deny too, unless a granting frame follows them ("may be used under ...").
WEAK_DENIAL = re.compile(r"\b(?:used|lists?|counts?|detects?|parses?|headers?|checks?|before|compatible)\b")
#: Over how many tasks the files with the same text, or the same recorded value, are dealt.
SALTS = 16
# The sentences that make a licence, from the public licence texts; alternatives of a licence are rows of their own.
BODIES = (
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights "
        "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    ),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("ISC", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License"),
    (
        "Apache-2.0",
        "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, "
        "publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    (
        "CC0-1.0",
        "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law, including all related and neighboring rights, to the extent allowed by law",
    ),
    (
        "CC-BY-NC-4.0",
        "By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of this Creative Commons Attribution-NonCommercial 4.0 International Public License (\"Public License\")",
    ),
)
#: The notices of the GNU licences differ in name, version and what follows it.
_GNU = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation, {}"
_FAMILIES = {"GPL-2.0": ("General Public License", "2"), "GPL-3.0": ("General Public License", "3"), "LGPL-2.1": ("Lesser General Public License", "2.1"), "LGPL-3.0": ("Lesser General Public License", "3"), "AGPL-3.0": ("Affero General Public License", "3")}
_ENDS = {"or-later": ("either version {} of the License, or (at your option) any later version",), "only": ("version {} of the License", "version {}", "version {} only", "version {} of the License only")}
_LIST = re.compile(r"^[ \t]*(?:\(?\d{1,2}[.)]|[*•\-]|\([a-z]\))[ \t]+", re.M)
# What differs between copies of a body besides spelling.
_SLOTS = (
    (re.compile(r"\bneither the names? of .{1,300}? nor the names? of (?:its|their|any|the) contributors\b", re.I | re.S), "neither the name of the copyright holder nor the names of its contributors"),
    (re.compile(r"\bthis (?:program|library|file|software|package|module) is free software\b", re.I), "this program is free software"),
)
COPYRIGHT = re.compile(r"(?:copyright|©|\(c\))\s*(?:\(c\)|©)?\s*\d{4}(?:\s*[-–,]\s*\d{4})*\s*,?\s*(?:by\s+)?(?:the\s+)?[\w.\-]*(?:\s+(?:authors?|contributors?|developers?|project|team))?", re.I)
MARKS = re.compile(r"^[ \t]*(?:/\*+|\*+/?|//+|#+|;+|--+|%+|<!--|\"\"\"|''')[ \t]*|[ \t]*(?:\*/|-->)[ \t]*$", re.M)
WORD = re.compile(r"[^\W\d_]+|\d+(?:\.\d+)*|[:=@]")
_VARIANTS = [(re.compile(p), r) for p, r in VARIANTS]


def _sentences(text: str) -> list[str]:
    t = MARKS.sub("", text.replace("\r\n", "\n"))
    t = COPYRIGHT.sub(" ", t)
    return [" ".join(x.split()) for x in re.split(r"[.;!?](?=\s|$)|\n[ \t]*\n", t) if x.strip()]


def _canonical(sentence: str) -> str:
    # a lower-case "mit" is a German preposition unless it is named as a licence
    s = re.sub(r"\bmit\b(?! licen[cs]e| terms)(?<!as mit)(?<!: mit)(?<!= mit)(?<!:  mit)", " ", sentence)
    s = s.lower()
    for p, r in _VARIANTS:
        s = p.sub(r, s)
    return s


def _number(w: str) -> str:
    return re.sub(r"(?:\.0)+$", "", w)


def names(text: str, recorded: bool = False) -> list[tuple[int, str, str]]:
    """(statement number, link to the one before, canonical name) of the names that a text states.

    recorded: the text is a scanner's id or expression, all of which counts.
    """
    out: list[tuple[int, str, str]] = []
    statement = -1
    for raw in [text] if recorded else _sentences(text):
        s = _canonical(" ".join(raw.split()) if not recorded else re.sub(r"\bmit\b", "MIT", raw))
        runs: list[tuple[int, int, list[str]]] = []  # where a run of name words begins and ends, and they
        words = [(m.group(), m.start(), m.end()) for m in WORD.finditer(s)]
        now: list[str] = []
        begin = end = -1
        for w, a, b in words:
            if w in NAME_WORDS or (w[0].isdigit()):
                if not now:
                    begin = a
                now.append(_number(w))
                end = b
            elif w in FILLERS and now:
                continue
            elif now:
                runs.append((begin, end, now))
                now = []
        if now:
            runs.append((begin, end, now))
        runs = [r for r in runs if any(w in NAME_WORDS for w in r[2]) and not set(r[2]) <= {"only", "later", "by", "clause", "nc"}]
        if not runs:
            continue
        outside = s
        for a, b, _ in reversed(runs):
            outside = outside[:a] + " " + outside[b:]
        alone = not [w for w in WORD.findall(outside) if w not in FILLERS and w not in ("either", "or", "and", "you", "choose", "at", "your", "choice", "option", "all", "rights", "reserved")]
        before = -1
        for a, b, run in runs:
            left = s[:a]
            between = s[before:a] if before >= 0 else ""
            link = ""
            if before >= 0:
                rest = [w for w in WORD.findall(between) if w not in FILLERS]
                link = "OR" if rest in (["or"], ["or", "either"]) else "AND" if rest == ["and"] else ""
            chained = bool(link) and out and out[-1][0] == statement
            granted = max((m.end() for m in GRANT.finditer(left)), default=-1)
            denied = bool(DENIAL.search(left)) or any(m.end() > granted for m in WEAK_DENIAL.finditer(left))
            if chained or recorded or alone or (granted >= 0 and not denied):
                if not chained:
                    statement += 1
                    link = ""
                out.append((statement, link, " ".join(sorted(run))))
                before = b
            else:
                before = -1
    return out


def units(text: str) -> list[str]:
    """Normalized sentences and paragraphs: words only, in lower case, in one spelling, without copyright notices and list marks."""
    t = MARKS.sub("", text.replace("\r\n", "\n"))
    t = COPYRIGHT.sub("\n\n", _LIST.sub("\n\n", t))
    for p, r in _SLOTS:
        t = p.sub(r, t)
    out = []
    for x in re.split(r"[.!?](?=\s|$)|\n[ \t]*\n", t):
        x = " ".join(x.split()).lower()
        for p, r in _VARIANTS:
            x = p.sub(r, x)
        if w := [_number(m) for m in WORD.findall(x) if m not in ":=@"]:
            out.append(" ".join(w))
    return out


def bodies() -> list[tuple[str, int, tuple[str, ...]]]:
    """(spdx, number, units) of all body templates."""
    rows = list(BODIES)
    for family, (name, version) in _FAMILIES.items():
        for mode, ends in _ENDS.items():
            rows += [(f"{family}-{mode}", _GNU.format(name, end.format(version))) for end in ends]
    return [(r[0], i, tuple(u for part in r[1:] for u in units(part))) for i, r in enumerate(rows)]


def templates(licenses: DataFrame) -> DataFrame:
    """(hash, spdx, body, parts): of the known licences canonical names made from their ids and titles (body null), EXTRA, and bodies.

    A body has as many rows as it has units (parts).
    """

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        extra: dict[str, list[str]] = {}
        for name, spdx in EXTRA.items():
            extra.setdefault(spdx, []).append(" ".join(sorted(name.split())))
        every = bodies()
        for p in batches:
            out = []
            for spdx, title in zip(p.spdx_id, p.title, strict=True):
                found = set(extra.get(spdx, ()))
                for text in (title, spdx):
                    if text and (n := names(text, recorded=True)) and len(n) == 1:
                        found.add(n[0][2])
                out += [(_hash(x), spdx, None, None) for x in sorted(found)]
                out += [(_hash(u), spdx, i, len(set(parts))) for s, i, parts in every if s == spdx for u in sorted(set(parts))]
            yield pd.DataFrame(out, columns=["hash", "spdx", "body", "parts"]).astype({"body": "Int32", "parts": "Int32"})

    made = licenses.select("spdx_id", "title").where("spdx_id <> ''").distinct().mapInPandas(make, "hash bigint, spdx string, body int, parts int")
    # a name that the ids of two licences give is that of the first
    return made.groupBy("hash", "body").agg(F.min(F.struct("spdx", "parts")).alias("t")).select("hash", "t.spdx", "body", "t.parts")


def _hash(name: str) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(name)).astype(np.int64))


def stated(texts: DataFrame, column: str, known: DataFrame, recorded: bool = False) -> DataFrame:
    """(key, license) of the distinct texts that state a known licence; key is the text's MD5. Choices are joined by OR, in alphabetical order."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            out = []
            for key, t in zip(p.key, p.text, strict=True):
                out += [(key, False, i, link, _hash(name)) for i, link, name in names(t, recorded)]
                out += [] if recorded else [(key, True, 0, "", _hash(u)) for u in set(units(t))]
            yield pd.DataFrame(out, columns=["key", "is_body", "statement", "link", "hash"])

    c = F.col(column)
    distinct = texts.where(c.isNotNull() & (c != "")).groupBy(F.md5(c).alias("key")).agg(F.any_value(c).alias("text"))
    found = distinct.mapInPandas(read, "key string, is_body boolean, statement int, link string, hash bigint").join(known, "hash").where(F.col("is_body") == F.col("body").isNotNull())
    # a row per statement of a name, and per body of which a unit is there
    each = found.groupBy("key", "body", "statement").agg(F.sort_array(F.collect_set("spdx")).alias("ids"), F.max("link").alias("link"), F.count("*").alias("n"), F.max("parts").alias("parts"))
    joined = F.when(F.col("link") == "AND", F.array_join("ids", " AND ")).otherwise(F.array_join("ids", " OR "))
    name = F.col("body").isNull()
    text = each.groupBy("key").agg(
        F.min_by(F.when(name, joined), F.when(name, F.col("statement"))).alias("named"),
        F.sort_array(F.collect_set(F.when(~name & (F.col("n") == F.col("parts")), F.col("ids")[0]))).alias("bodies"),
    )
    # the sentences of the two-clause licence are among those of the other
    bodies_ = F.when(F.array_contains("bodies", "BSD-3-Clause"), F.array_remove("bodies", "BSD-2-Clause")).otherwise(F.col("bodies"))
    return text.select("key", F.coalesce("named", F.nullif(F.array_join(bodies_, " AND "), F.lit(""))).alias("license")).where("license is not null")


def _looked_up(rows: DataFrame, column: str, table: DataFrame, out: str) -> DataFrame:
    """rows with `out`: the licence of the text in `column`, null where it states none. Rows of one text are dealt over SALTS tasks."""
    salted = table.select(F.col("key").alias("__k"), F.col("license").alias(out), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__s"))
    r = rows.withColumns({"__key": F.md5(column), "__salt": F.pmod(F.xxhash64("repo_full_name", "file_path"), F.lit(SALTS)).cast("int")}).drop(column)
    return r.join(salted, (F.col("__key") == F.col("__k")) & (F.col("__salt") == F.col("__s")), "left").drop("__key", "__salt", "__k", "__s")


def _all_of(c: str):
    """Differing statements joined by AND, null if there is none."""
    return F.nullif(F.array_join(F.sort_array(F.collect_set(c)), " AND "), F.lit(""))


def resolve(provenance: DataFrame, licenses: DataFrame) -> DataFrame:
    """(repo_full_name, file_path, license, flag): a row per file and one per repository (file_path '')."""
    known = templates(licenses)
    rows = provenance.select("repo_full_name", "file_path", "license_text", "license_spdx")
    looked = _looked_up(rows, "license_text", stated(rows, "license_text", known), "own")
    looked = _looked_up(looked, "license_spdx", stated(rows, "license_spdx", known, recorded=True), "recorded")
    files = looked.groupBy("repo_full_name", "file_path").agg(_all_of("own").alias("own"), _all_of("recorded").alias("recorded"))
    root = files.where(~F.contains("file_path", F.lit("/")))
    repos = root.groupBy("repo_full_name").agg(_all_of("own").alias("repo_own"), _all_of("recorded").alias("repo_recorded"))
    every = rows.select("repo_full_name").distinct()
    r = repos.withColumnRenamed("repo_full_name", "r")
    same = F.col("repo_full_name").eqNullSafe(F.col("r"))
    of_files = files.join(r, same, "left").select("repo_full_name", "file_path", F.array("own", "repo_own", "recorded").alias("evidence"))
    of_repos = every.join(r, same, "left").select("repo_full_name", F.lit("").alias("file_path"), F.array("repo_own", "repo_recorded").alias("evidence"))
    pieces = of_files.union(of_repos).withColumn("evidence", F.array_compact("evidence"))
    n = F.size(F.array_distinct("evidence"))
    return pieces.select(
        "repo_full_name",
        "file_path",
        F.coalesce(F.get("evidence", F.lit(0)), F.lit("unknown")).alias("license"),
        F.when(n == 0, "unknown").when(n > 1, "conflict").otherwise("ok").alias("flag"),
    )
