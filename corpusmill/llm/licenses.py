"""Licence scans in native functions: notices compared to templates by word bigrams.

The units of a text are its lines and sentences, and the text itself. A unit
and a template have the Dice coefficient of their sets of word bigrams. Two
sets whose sizes differ too much cannot reach the threshold, so only templates
within the size bounds are compared. A unit that reaches it shares so many
bigrams with the template that it must contain one of a few chosen ones; texts
and units without any of these are passed over, which loses nothing.

A template that no unit reaches is looked for in passages: windows of words
across line breaks, or inside a line too long to be a unit.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Texts of licences.
MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions:")
MIT_REST = (
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
    "Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED "
    "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS "
    "OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
ISC_REST = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE.")
BSD_TWO = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution.")
BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission.")
BSD_REST = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
    "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
APACHE = (
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
    "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
    "law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
    "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
    "permissions and limitations under the License.")
GNU = tuple((name, kind, (
    f"This program is free software{':' if version == '3' else ';'} you can redistribute it and/or modify it under the terms of "
    f"the GNU {kind} License as published by the Free Software Foundation, either version {version} of the License, or (at your "
    f"option) any later version.")) for name, kind, version in (
        ("GPL-2.0", "General Public", "2"), ("GPL-3.0", "General Public", "3"), ("LGPL-3.0", "Lesser General Public", "3"),
        ("AGPL-3.0", "Affero General Public", "3")))
GNU_REST = (
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
    "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0} License for more details. You should have "
    "received a copy of the GNU {0} License along with this program. If not, see <https://www.gnu.org/licenses/>.")

#: Names and usual notices of licences.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License"),
    ("MIT", "This project is licensed under the terms of the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "You may not use this file except in compliance with the License"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("MIT", "MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", MIT_GRANT),
    ("MIT", f"{MIT_GRANT} {MIT_REST}"),
    ("ISC", f"Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            f"granted, provided that the above copyright notice and this permission notice appear in all copies. {ISC_REST}"),
    ("BSD", f"{BSD_TWO} {BSD_REST}"),
    ("BSD", f"{BSD_TWO} {BSD_THIRD} {BSD_REST}"),
    ("Apache-2.0", APACHE),
    *((name, f"{head} {GNU_REST.format(kind)}") for name, kind, head in GNU),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
                "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
)


@dataclass(frozen=True)
class Licenses:
    """``dice`` in percent, so that comparisons stay in whole numbers."""

    templates: tuple[tuple[str, str], ...] = TEMPLATES
    dice: int = 75


def template_bigrams(text: str) -> list[str]:
    words = re.findall("[a-z0-9]+", text.lower())
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def anchors(p: Licenses) -> list[str]:
    """Bigrams of which every unit that reaches the threshold contains at least one.

    A unit of size a and a template of size b need dice * (a + b) / 200 common
    bigrams, and a is at least b * dice / (200 - dice). So all but one less
    than the least common number are enough; the longest are kept, being rare.
    """
    out: set[str] = set()
    for _, text in p.templates:
        own = template_bigrams(text)
        least = math.ceil(p.dice * len(own) * (1 + p.dice / (200 - p.dice)) / 200 - 1e-9)
        out |= set(sorted(own, key=lambda x: (-len(x), x))[:len(own) - max(1, least) + 1])
    return sorted(out)


def _pattern(grams: list[str]) -> str:
    """Any of the bigrams, first words by first letter, so that few alternatives are tried at a place."""
    seconds: dict[str, dict[str, list[str]]] = {}
    for a, b in (x.split(" ") for x in grams):
        seconds.setdefault(a[0], {}).setdefault(a[1:], []).append(b)
    firsts = (c + "(?:" + "|".join(f"{a}[^a-z0-9]+(?:{'|'.join(bs)})" for a, bs in of.items()) + ")"
              for c, of in seconds.items())
    return rf"(?<![a-z0-9])(?:{'|'.join(firsts)})(?![a-z0-9])"


def _bigrams(words: Column) -> Column:
    return F.array_distinct(F.zip_with(F.slice(words, F.lit(1), F.size(words) - 1), F.slice(words, F.lit(2), F.size(words) - 1),
                                       lambda a, b: F.concat_ws(" ", a, b)))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def passages(text: Column, reached: Column, p: Licenses) -> Column:
    """``less, name, t, at, end``: of each template not in ``reached`` the best passage, if it reaches the threshold.

    A passage begins and ends with bigrams of the template. Taking in one more
    bigram of the template beside it never lowers its coefficient, so only
    whole runs of the template's bigrams are tried as ends, and runs with too
    few others near are no ends at all. A passage inside one line counts only
    if the line has more words than a unit can; others are left to the units.
    """
    own = [template_bigrams(t) for _, t in p.templates]
    longest = max(map(len, own)) * (200 - p.dice) // p.dice + 1
    every = sorted({g for grams in own for g in grams})
    # Of a template of b bigrams: the least common ones, and the most places of a passage (repeated bigrams count again).
    bounds = [(max(1, math.ceil(p.dice * len(g) * (1 + p.dice / (200 - p.dice)) / 200 - 1e-9)),
               2 * (len(g) * (200 - p.dice) // p.dice)) for g in own]
    number = {g: i for i, g in enumerate(every)}
    templates = F.array(*(F.struct(F.lit(i).alias("t"), F.lit(name).alias("name"), F.lit(least).alias("least"),
                                   F.lit(most).alias("most"), F.array(*(F.lit(number[x]) for x in g)).alias("grams"))
                          for i, ((name, _), g, (least, most)) in enumerate(zip(p.templates, own, bounds, strict=True))))
    lines = F.transform(F.split(text, r"\n"), lambda x: F.regexp_extract_all(x, F.lit("[a-z0-9]+"), F.lit(0)))
    words = F.flatten(F.transform(lines, lambda ws, i: F.transform(ws, lambda w: F.struct(
        w.alias("w"), F.when(F.size(ws) <= longest, i).alias("line")))))
    grams = lambda ws: F.zip_with(F.slice(ws, F.lit(1), F.size(ws) - 1), F.slice(ws, F.lit(2), F.size(ws) - 1),
                                  lambda a, b: F.struct(F.concat_ws(" ", a["w"], b["w"]).alias("g"),
                                                        a["line"].alias("a"), b["line"].alias("b")))
    known = lambda gs: F.filter(F.transform(gs, lambda x, i: F.struct(
        F.when(x["g"].isin(every), x["g"]).alias("g"), i.alias("i"), x["a"].alias("a"), x["b"].alias("b"))),
        lambda x: x["g"].isNotNull())
    numbered = lambda xs: F.transform(xs, lambda x: x.withField("g", F.array_position(
        F.array(*map(F.lit, every)), x["g"]).cast("int") - 1))
    place = lambda xs, k: F.get(xs, k)["i"]

    def of(t: Column, near: Column, gs: Column) -> Column:
        """Passages of one template; ``near`` are all bigrams of any template, ``gs`` all of the text."""
        def tried(xs: Column) -> Column:
            runs = F.filter(F.transform(xs, lambda x, k: F.struct(
                x["i"].alias("i"), k.alias("k"), x["a"].alias("a"), x["b"].alias("b"),
                ((k == 0) | (place(xs, k - 1) != x["i"] - 1)).alias("first"),
                ((k == F.size(xs) - 1) | (place(xs, k + 1) != x["i"] + 1)).alias("last"))),
                lambda r: r["first"] | r["last"])
            starts = F.filter(runs, lambda r: r["first"] & (place(xs, r["k"] + t["least"] - 1) - r["i"] < t["most"]))

            def ended(s: Column, all_runs: Column) -> Column:
                ends = F.filter(all_runs, lambda e: e["last"] & (e["k"] >= s["k"] + t["least"] - 1)
                                & (e["i"] - s["i"] < t["most"]) & (s["a"].isNull() | e["b"].isNull() | (s["a"] != e["b"])))
                return F.transform(ends, lambda e: F.struct(
                    F.size(F.array_distinct(F.transform(F.slice(xs, s["k"] + 1, e["k"] - s["k"] + 1), lambda x: x["g"]))).alias("both"),
                    (F.size(t["grams"]) + F.size(F.array_distinct(F.transform(
                        F.slice(gs, s["i"] + 1, e["i"] - s["i"] + 1), lambda x: x["g"])))).alias("sum"),
                    s["i"].alias("at"), e["i"].alias("end")))

            # Ends are looked for among the runs that can follow, not among those of the whole text.
            follow = lambda s: F.slice(xs, s["k"] + 1, t["most"])
            local = lambda s: F.filter(F.transform(follow(s), lambda x, j: F.struct(
                x["i"].alias("i"), (s["k"] + j).alias("k"), x["a"].alias("a"), x["b"].alias("b"),
                F.coalesce(place(xs, s["k"] + j + 1) != x["i"] + 1, F.lit(True)).alias("last"))), lambda x: x["last"])
            return F.flatten(F.transform(starts, lambda s: _let(local(s), lambda rs: ended(s, rs))))

        mine = F.filter(near, lambda x: F.array_contains(t["grams"], x["g"]))
        found = F.when(F.size(near) >= t["least"], _let(mine, tried))
        reach = F.filter(found, lambda c: 200 * c["both"] >= p.dice * c["sum"])
        return F.array_min(F.transform(reach, lambda c: F.struct(
            (-2.0 * c["both"] / c["sum"]).alias("less"), t["name"].alias("name"), t["t"].alias("t"),
            c["at"].alias("at"), c["end"].alias("end"))))

    left = F.filter(templates, lambda t: ~F.array_contains(reached, t["t"]))
    best = _let(_let(words, grams), lambda gs: _let(numbered(known(gs)), lambda near: F.transform(left, lambda t: of(t, near, gs))))
    return F.filter(best, lambda m: m.isNotNull())


def scan(docs: DataFrame, p: Licenses = Licenses()) -> DataFrame:
    """``doc_id, license, dice, n_units, licenses`` of every row of ``docs`` (doc_id, text).

    ``licenses`` has the names found, sorted and joined by commas, ``license``
    the name of the best match (ties: the first name) and ``dice`` its
    coefficient, ``n_units`` the different units and passages that match. Words are runs of ASCII letters and
    digits, in lower case. Null and empty texts, and such without a match, have
    null, 0.0, 0 and an empty list. Everything happens inside a row: nothing is
    shuffled and a long text is split, not multiplied.
    """
    anchor = _pattern(anchors(p))
    templates = F.array(*(F.struct(F.lit(i).alias("t"), F.lit(name).alias("name"),
                                   F.array(*map(F.lit, template_bigrams(text))).alias("grams"))
                          for i, (name, text) in enumerate(p.templates)))
    words = lambda t: F.regexp_extract_all(t, F.lit("[a-z0-9]+"), F.lit(0))
    longest = max(len(template_bigrams(t)) for _, t in p.templates) * (200 - p.dice) // p.dice + 1

    rows = docs.select("doc_id", F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text"))
    hit = F.col("text").rlike(anchor)
    units = F.array_distinct(F.concat(F.split("text", r"\n"), F.split("text", r"\n|(?<=[.!?])\s+"), F.array("text")))
    rows = rows.withColumn("units", F.when(hit, F.filter(units, lambda u: u.rlike(anchor))))
    # Different units, as words; a unit of many more words than any template cannot match.
    rows = rows.withColumn("grams", F.array_distinct(F.filter(F.transform("units", lambda u: _bigrams(words(u))),
                                                              lambda g: F.size(g).between(1, longest))))

    def best(g: Column) -> Column:
        size = F.size(g)
        near = F.filter(templates, lambda t: (p.dice * F.size(t["grams"]) <= (200 - p.dice) * size)
                        & (p.dice * size <= (200 - p.dice) * F.size(t["grams"])))
        compared = F.transform(near, lambda t: F.struct(
            F.size(F.array_intersect(t["grams"], g)).alias("both"), (F.size(t["grams"]) + size).alias("sum"),
            t["name"].alias("name"), t["t"].alias("t")))
        return F.transform(F.filter(compared, lambda c: 200 * c["both"] >= p.dice * c["sum"]), lambda c: F.struct(
            (-2.0 * c["both"] / c["sum"]).alias("less"), c["name"].alias("name"), c["t"].alias("t")))

    rows = rows.withColumn("matches", F.transform("grams", best))
    rows = rows.withColumn("matches", F.filter("matches", lambda m: F.size(m) > 0)).withColumn("flat", F.flatten("matches"))
    rows = rows.withColumn("passages", F.when(hit, passages(F.col("text"), F.transform("flat", lambda m: m["t"]), p)))
    rows = rows.withColumn("all", F.array_sort(F.concat("flat", F.transform("passages", lambda m: F.struct(
        m["less"].alias("less"), m["name"].alias("name"), m["t"].alias("t"))))))
    top = F.try_element_at("all", F.lit(1))
    return rows.select(
        "doc_id", top["name"].alias("license"), F.coalesce(-top["less"], F.lit(0.0)).alias("dice"),
        F.coalesce(F.size("matches") + F.size(F.array_distinct(F.transform("passages", lambda m: F.struct(m["at"], m["end"])))),
                   F.lit(0)).cast("long").alias("n_units"),
        F.coalesce(F.array_join(F.array_sort(F.array_distinct(F.transform("all", lambda m: m["name"]))), ","),
                   F.lit("")).alias("licenses"))
