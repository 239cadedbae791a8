"""Licence scans: TF-IDF cosine of lines, windows of lines and files to licence texts, then inheritance by directory.

All columns are built from SQL functions. The vector of a text has one weight per word: how often the word occurs times
its inverse document frequency in the whole table; words that occur in no template weigh ``UNKNOWN`` each time. Notices
and titles are compared with every line, and with every window of two lines without a licence of their own; whole
licence texts with whole files. Lines without a word do not count. A text has a licence if all deciding words of a
template, the version among them, occur in it, it is at most ``LONGER`` times as long, and the cosine reaches
``THRESHOLD``; of several the highest cosine counts.

A licence file is a file that as a whole is like a licence text, one that begins with the title of a licence, or one
whose words stand mostly in lines with a licence. It licenses its directory; a file without a licence of its own takes
that of the nearest directory above it that has one. Several licence files of a directory: the highest cosine, then the
first name.

A null or empty text has no licence of its own; a null path is a file in the root; repeated rows are scanned and
returned as often as they occur; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from fleet.operators.keys import join_on
from fleet.scratch import Scratch

THRESHOLD = 0.75
#: Weight of a word of no template, about that of a word in every third text.
UNKNOWN = 2.0
LONGER = 3
#: Share of a file's words in licence lines that makes it a licence file.
FILE_SHARE = 0.5
WORD = "[a-z0-9]+(?:[.-][a-z0-9]+)*"

#: Licence, words that must occur (the first one picks the lines to compare), and the usual sentence.
NOTICES = [
    ("Apache-2.0", "apache 2.0", "Licensed under the Apache License, Version 2.0"),
    ("MIT", "license mit", "Released under the MIT License"),
    ("MIT", "permission granted charge", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("GPL-2.0", "gnu general 2", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "gnu general 3", "This work is licensed under the GNU General Public License, version 3"),
    ("LGPL-2.1", "gnu lesser 2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1"),
    ("LGPL-3.0", "gnu lesser 3", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "gnu affero 3", "This work is licensed under the GNU Affero General Public License, version 3"),
    ("BSD", "redistribution binary", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("ISC", "permission fee", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("MPL-2.0", "mozilla 2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("CC-BY-4.0", "cc by 4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "cc by-sa 4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "cc by-nc 4.0", "Licensed under CC BY-NC 4.0"),
    ("all-rights-reserved", "reserved rights", "All rights reserved"),
]

#: The titles with which the long licences begin.
TITLES = [
    ("Apache-2.0", "apache 2.0", "Apache License Version 2.0, January 2004"),
    ("GPL-2.0", "gnu general 2", "GNU General Public License Version 2, June 1991"),
    ("GPL-3.0", "gnu general 3", "GNU General Public License Version 3, 29 June 2007"),
    ("LGPL-2.1", "gnu lesser 2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("LGPL-3.0", "gnu lesser 3", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("AGPL-3.0", "gnu affero 3", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("MPL-2.0", "mozilla 2.0", "Mozilla Public License Version 2.0"),
]

_BSD_START = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY,
OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE."""

#: The short licences as a whole, without the lines that name the holder.
TEXTS = [
    ("MIT", "permission sublicense", """MIT License
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice
shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY
OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR
PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR
THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", "permission fee", """ISC License
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS"
AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS
ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("BSD-2-Clause", "redistributions binary", f"{_BSD_START} {_BSD_END}"),
    ("BSD-3-Clause", "redistributions binary endorse", f"{_BSD_START} {_BSD_NAMES} {_BSD_END}"),
]


def _found(text: str) -> list[str]:
    return re.findall(WORD, text.lower())


@dataclass(frozen=True)
class Template:
    licence: str
    deciding: list[str]
    words: list[str]
    kind: str  # notice or text
    title: int = 0

    @property
    def counts(self) -> list[tuple[str, int]]:
        return sorted(Counter(self.words).items())


def _tags() -> list[Template]:
    """The one-line tags by which source files name a licence."""
    names = sorted({n for n, _, _ in NOTICES + TEXTS} - {"all-rights-reserved", "BSD"})
    forms = [(n, n + ending) for n in names for ending in ("", *(("-only", "-or-later") if "GPL" in n else ()))]
    return [Template(n, ["spdx-license-identifier", form.lower()], _found(f"SPDX-License-Identifier: {form}"), "notice") for n, form in forms]


TEMPLATES = [
    *(Template(n, d.split(), _found(t), "notice") for n, d, t in NOTICES), *(Template(n, d.split(), _found(t), "notice", 1) for n, d, t in TITLES),
    *_tags(), *(Template(n, d.split(), _found(t), "text") for n, d, t in TEXTS),
]
VOCABULARY = sorted({w for t in TEMPLATES for w in t.words + t.deciding})
#: A line is compared only if it has one of these, without which no template can be met.
KEYS = sorted({t.deciding[0] for t in TEMPLATES})


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _all_words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def _map(pairs: list[tuple[str, float]]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs for x in pair])


def term_weights(df: DataFrame, text: str = "text") -> dict[str, float]:
    """Inverse document frequency of the templates' words over all rows; one row per word reaches the driver."""
    found = F.explode(F.array_intersect(_all_words(F.col(text)), _strings(VOCABULARY)))
    counts = {r.term: r.n for r in df.select(found.alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = df.count()
    return {w: math.log((1 + rows) / (1 + counts.get(w, 0))) + 1 for w in VOCABULARY}


class _Comparison:
    """Columns that compare arrays of words with the templates."""

    def __init__(self, weights: dict[str, float]):
        self.squares = {w: x * x for w, x in weights.items()}
        self.weight = _map(sorted(self.squares.items()))

    def _templates(self, kind: str) -> Column:
        return F.array(*[
            F.struct(
                F.lit(t.licence).alias("name"), F.lit(t.title).alias("title"), _strings(t.deciding).alias("deciding"), F.lit(LONGER * len(t.words)).alias("most"),
                F.lit(sum(c * c * self.squares[w] for w, c in t.counts)).alias("square"), _map([(w, c * self.squares[w]) for w, c in t.counts]).alias("terms"),
            )
            for t in TEMPLATES if t.kind == kind
        ])

    def _square(self, words: Column) -> Column:
        """Squared length: the nth occurrence of a word adds 2n - 1 times its squared weight."""

        def add(sum_: Column, word: Column) -> Column:
            nth = F.when(word == sum_["word"], sum_["nth"] + 1).otherwise(F.lit(1))
            square = F.coalesce(F.element_at(self.weight, word), F.lit(UNKNOWN**2))
            return F.struct(word.alias("word"), nth.alias("nth"), (sum_["total"] + square * (2 * nth - 1)).alias("total"))

        start = F.struct(F.lit("").alias("word"), F.lit(0).alias("nth"), F.lit(0.0).alias("total"))
        return F.aggregate(F.array_sort(words), start, add, lambda sum_: sum_["total"])

    def best(self, words: Column, kind: str) -> Column:
        """The nearest template as ``minus`` (the negative cosine), ``name`` and ``title``; null without one."""
        fits = lambda t: (F.size(words) <= t["most"]) & F.forall(t["deciding"], lambda w: F.array_contains(words, w))
        dot = lambda t: F.aggregate(words, F.lit(0.0), lambda sum_, w: sum_ + F.coalesce(F.element_at(t["terms"], w), F.lit(0.0)))
        one = lambda t: F.struct(F.round(-dot(t) / F.sqrt(self._square(words) * t["square"]), 6).alias("minus"), t["name"].alias("name"), t["title"].alias("title"))
        return F.array_min(F.filter(F.transform(F.filter(self._templates(kind), fits), one), lambda x: x["minus"] <= -THRESHOLD))


def scan_lines(df: DataFrame, weights: dict[str, float], text: str = "text") -> DataFrame:
    """Add ``licence``, ``score``, ``licences`` (all found, by name) and ``is_licence_file``."""
    compared = _Comparison(weights)
    lines = F.filter(F.transform(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), _all_words), lambda words: F.size(words) > 0)
    keyed = F.transform("_lines", lambda words: F.arrays_overlap(words, _strings(KEYS)))
    none = F.array().cast("array<int>")
    places = F.when(F.exists("_keyed", lambda k: k), F.sequence(F.lit(0), F.size("_lines") - 1)).otherwise(none)
    n_words = F.aggregate("_lines", F.lit(0).cast("long"), lambda sum_, words: sum_ + F.size(words))

    unit = lambda at, upto, words: F.struct(at.alias("at"), upto.alias("upto"), compared.best(words, "notice").alias("best"))
    ones = F.transform(F.filter("_places", lambda i: F.get("_keyed", i)), lambda i: unit(i, i, F.get("_lines", i)))
    own = lambda i: F.exists("_ones", lambda u: (u["at"] >= i) & (u["at"] <= i + 1))
    beside = F.filter("_places", lambda i: (i + 1 < F.size("_lines")) & (F.get("_keyed", i) | F.get("_keyed", i + 1)) & ~own(i))
    twos = F.transform(beside, lambda i: unit(i, i + 1, F.concat(F.get("_lines", i), F.get("_lines", i + 1))))
    with_best = lambda units: F.filter(units, lambda u: u["best"].isNotNull())
    longest = LONGER * max(len(t.words) for t in TEMPLATES if t.kind == "text")
    whole = F.when((F.size("_places") > 0) & (F.col("_n") <= longest), compared.best(F.flatten("_lines"), "text"))

    met = lambda i: F.exists("_units", lambda u: (u["at"] <= i) & (u["upto"] >= i))
    covered = F.aggregate(F.filter("_places", met), F.lit(0).cast("long"), lambda sum_, i: sum_ + F.size(F.get("_lines", i)))
    bests = F.transform("_units", lambda u: u["best"])
    title = F.array_min(F.transform(F.filter("_units", lambda u: (u["at"] == 0) & (u["best"]["title"] == 1)), lambda u: u["best"]))
    helpers = ("_lines", "_keyed", "_places", "_n", "_ones", "_units", "_whole", "_title", "_best")
    return (
        df.drop("licence", "score", "licences", "is_licence_file", *helpers)
        .withColumn("_lines", lines).withColumn("_keyed", keyed).withColumns({"_places": places, "_n": n_words})
        .withColumn("_ones", with_best(ones)).withColumns({"_units": F.concat("_ones", with_best(twos)), "_whole": whole})
        .withColumn("_title", title).withColumn("_best", F.coalesce("_whole", "_title", F.array_min(bests)))
        .withColumns({
            "licence": F.col("_best.name"), "score": -F.col("_best.minus"),
            "licences": F.array_join(F.array_sort(F.array_distinct(F.transform(F.filter(F.concat(bests, F.array("_whole")), lambda b: b.isNotNull()), lambda b: b["name"]))), ","),
            "is_licence_file": F.coalesce("_whole", "_title").isNotNull() | ((F.size("_units") > 0) & (covered >= FILE_SHARE * F.col("_n"))),
        })
        .drop(*helpers)
    )


def inherit(scanned: DataFrame, path: str = "path") -> DataFrame:
    """Add ``inherited`` and ``inherited_from`` from licence files, and ``effective``: own or inherited licence.

    Only directories are expanded to their ancestors and joined by path; files then meet their directory's row.
    """
    directory = F.regexp_replace(F.coalesce(F.col(path), F.lit("")), "(^|/)[^/]*$", "")
    placed = scanned.drop("inherited", "inherited_from", "effective").withColumn("_dir", directory)
    licensed = placed.where("is_licence_file").groupBy(F.col("_dir").alias("_above")).agg(
        F.min(F.struct((-F.col("score")).alias("minus"), F.col("licence").alias("name")))["name"].alias("inherited"),
    )
    parts = F.filter(F.split("_dir", "/"), lambda p: p != "")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    ancestors = placed.select("_dir").distinct().select("_dir", F.posexplode(above).alias("_depth", "_above"))
    nearest = ancestors.join(licensed, "_above").groupBy("_dir").agg(
        F.max(F.struct("_depth", "inherited", F.col("_above").alias("inherited_from"))).alias("_near"),
    ).select("_dir", "_near.inherited", "_near.inherited_from")
    return join_on(placed, nearest, ["_dir"], "left").withColumn("effective", F.coalesce("licence", "inherited")).drop("_dir")


def scan(df: DataFrame, text: str = "text", path: str = "path") -> DataFrame:
    """Own and inherited licence of every file. The scan of the texts is stored once; inheritance reads it three times."""
    scanned = scan_lines(df, term_weights(df, text), text).drop(text)
    return inherit(Scratch(df.sparkSession).store(scanned, "scanned"), path)


def scan_sql(table: str) -> str:
    """The same scan of ``table (doc_id, path, text)`` in DuckDB's SQL; ``doc_id`` tells its rows apart."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    values = lambda rows: ", ".join("(" + ", ".join(quoted(x) if isinstance(x, str) else str(x) for x in row) + ")" for row in rows)
    numbered = list(enumerate(TEMPLATES))
    return f"""
    WITH files AS ({table}),
    templates(k, name, kind, title, most, needed) AS (VALUES {values((k, t.licence, t.kind, t.title, LONGER * len(t.words), len(t.deciding)) for k, t in numbered)}),
    terms(k, term, tf) AS (VALUES {values((k, *pair) for k, t in numbered for pair in t.counts)}),
    deciding(k, term) AS (VALUES {values((k, w) for k, t in numbered for w in t.deciding)}),
    vocabulary(term) AS (VALUES {values((w,) for w in VOCABULARY)}),
    raw AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM files),
    found AS (SELECT doc_id, i, regexp_extract_all(lower(line), '{WORD}') AS ws FROM raw),
    lines AS (SELECT doc_id, ws, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS pos FROM found WHERE len(ws) > 0),
    units AS (SELECT doc_id, pos, pos AS upto, 'notice' AS kind, ws FROM lines
              UNION ALL SELECT a.doc_id, a.pos, b.pos, 'notice', list_concat(a.ws, b.ws) FROM lines a JOIN lines b ON b.doc_id = a.doc_id AND b.pos = a.pos + 1
              UNION ALL SELECT doc_id, 0, max(pos), 'text', flatten(list(ws ORDER BY pos)) FROM lines GROUP BY doc_id),
    words AS (SELECT doc_id, pos, upto, kind, unnest(ws) AS term FROM units),
    counts AS (SELECT doc_id, pos, upto, kind, term, count(*) AS c FROM words GROUP BY doc_id, pos, upto, kind, term),
    idf AS (SELECT v.term, power(ln((1.0 + (SELECT count(*) FROM files)) / (1 + count(t.doc_id))) + 1, 2) AS w
            FROM vocabulary v LEFT JOIN (SELECT doc_id, term FROM counts WHERE kind = 'text') t USING (term) GROUP BY v.term),
    own AS (SELECT doc_id, pos, upto, kind, sum(c) AS n, sum(c * c * coalesce(w, {UNKNOWN**2}) ORDER BY term) AS square
            FROM counts LEFT JOIN idf USING (term) GROUP BY doc_id, pos, upto, kind),
    squares AS (SELECT k, sum(tf * tf * w ORDER BY term) AS square FROM terms JOIN idf USING (term) GROUP BY k),
    decided AS (SELECT c.doc_id, c.pos, c.upto, c.kind, t.k, t.name, t.title, t.most
                FROM counts c JOIN deciding d USING (term) JOIN templates t ON t.k = d.k AND t.kind = c.kind
                GROUP BY c.doc_id, c.pos, c.upto, c.kind, t.k, t.name, t.title, t.most, t.needed HAVING count(*) = t.needed),
    dots AS (SELECT d.doc_id, d.pos, d.upto, d.kind, d.k, d.name, d.title, d.most, sum(c.c * t.tf * i.w ORDER BY t.term) AS dot
             FROM decided d JOIN counts c ON c.doc_id = d.doc_id AND c.pos = d.pos AND c.upto = d.upto AND c.kind = d.kind
             JOIN terms t ON t.k = d.k AND t.term = c.term JOIN idf i ON i.term = c.term
             GROUP BY d.doc_id, d.pos, d.upto, d.kind, d.k, d.name, d.title, d.most),
    scores AS (SELECT d.doc_id, d.pos, d.upto, d.kind, d.name, d.title, round(-d.dot / sqrt(o.square * s.square), 6) AS minus
               FROM dots d JOIN own o ON o.doc_id = d.doc_id AND o.pos = d.pos AND o.upto = d.upto AND o.kind = d.kind
               JOIN squares s ON s.k = d.k WHERE o.n <= d.most),
    near AS (SELECT doc_id, pos, upto, kind, min((minus, name, title)) AS b FROM scores WHERE minus <= -{THRESHOLD} GROUP BY doc_id, pos, upto, kind),
    best AS (SELECT * FROM near n WHERE kind = 'text' OR pos = upto
             OR NOT EXISTS (SELECT 1 FROM near o WHERE o.kind = 'notice' AND o.pos = o.upto AND o.doc_id = n.doc_id AND o.pos BETWEEN n.pos AND n.upto)),
    chosen AS (SELECT doc_id, min(b) FILTER (kind = 'text') AS whole, min(b) FILTER (kind = 'notice' AND pos = 0 AND b[3] = 1) AS title,
                      min(b) FILTER (kind = 'notice') AS notice, string_agg(DISTINCT b[2], ',' ORDER BY b[2]) AS licences FROM best GROUP BY doc_id),
    covered AS (SELECT doc_id, sum(len(ws)) AS m FROM lines l
                WHERE EXISTS (SELECT 1 FROM best b WHERE b.kind = 'notice' AND b.doc_id = l.doc_id AND l.pos BETWEEN b.pos AND b.upto) GROUP BY doc_id),
    total AS (SELECT doc_id, sum(len(ws)) AS n FROM lines GROUP BY doc_id),
    scanned AS (SELECT f.doc_id, f.path, regexp_replace(coalesce(f.path, ''), '(^|/)[^/]*$', '') AS dir, coalesce(c.whole, c.title, c.notice)[2] AS licence,
                       -coalesce(c.whole, c.title, c.notice)[1] AS score, coalesce(c.licences, '') AS licences,
                       c.whole IS NOT NULL OR c.title IS NOT NULL OR coalesce(m.m >= {FILE_SHARE} * t.n, false) AS is_licence_file
                FROM files f LEFT JOIN chosen c USING (doc_id) LEFT JOIN covered m USING (doc_id) LEFT JOIN total t USING (doc_id)),
    licensed AS (SELECT dir AS above, min((-score, licence))[2] AS inherited FROM scanned WHERE is_licence_file GROUP BY dir),
    dirs AS (SELECT DISTINCT dir FROM scanned),
    reached AS (SELECT dir, above, inherited, length(above) AS depth FROM dirs JOIN licensed ON above = '' OR dir = above OR starts_with(dir, above || '/')),
    nearest AS (SELECT dir, arg_max(inherited, depth) AS inherited, arg_max(above, depth) AS inherited_from FROM reached GROUP BY dir)
    SELECT doc_id, path, licence, score, licences, is_licence_file, inherited, inherited_from, coalesce(licence, inherited) AS effective
    FROM scanned LEFT JOIN nearest USING (dir)"""
