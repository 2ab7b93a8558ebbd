"""Licence notices found by Dice coefficient over word bigrams.

Texts are normalised (A-Z lower-cased, all but a-z and 0-9 taken as gaps), and
their passages are compared with templates by ``2 * shared / (bigrams of the
passage + of the template)``. A passage can only reach the threshold t with a
template of m bigrams if its own number lies between m * t / (2 - t) and
m * (2 - t) / t. So most texts are dropped as they hold too few bigrams of any
template, and passages outside these bounds are never compared. DataFrame
functions only; nothing is shuffled.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.75
# Customary licence notices, one line each, by SPDX identifier.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except"
                   " in compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"
                     " provided that the following conditions are met:"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
            " associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("proprietary", "All rights reserved."),
)

# Whole licence texts and file headers without their copyright lines, by SPDX identifier.
_BSD_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
    " following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of"
    " conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,"
    " this list of conditions and the following disclaimer in the documentation and/or other materials provided with the"
    " distribution."
)
_BSD_ENDORSEMENT = (
    " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"
    " derived from this software without specific prior written permission."
)
_BSD_DISCLAIMER = (
    " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES,"
    " INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE"
    " DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,"
    " SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;"
    " LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN"
    " CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS"
    " SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_GPL_HEADER = (
    "This program is free software{colon} you can redistribute it and/or modify it under the terms of the GNU General Public"
    " License as published by the Free Software Foundation{either} version {number} of the License, or (at your option) any"
    " later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even"
    " the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more"
    " details. You should have received a copy of the GNU General Public License along with this program"
)
WHOLE_TEXTS = (
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
            " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation"
            " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and"
            " to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above"
            " copyright notice and this permission notice shall be included in all copies or substantial portions of the"
            " Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT"
            " LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT"
            " SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF"
            " CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS"
            " IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
            " granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS"
            " PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED"
            " WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,"
            " INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER"
            " IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR"
            " PERFORMANCE OF THIS SOFTWARE."),
    ("BSD-2-Clause", _BSD_CONDITIONS + _BSD_DISCLAIMER),
    ("BSD-3-Clause", _BSD_CONDITIONS + _BSD_ENDORSEMENT + _BSD_DISCLAIMER),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in"
                   " compliance with the License. You may obtain a copy of the License at"
                   " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,"
                   " software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR"
                   " CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing"
                   " permissions and limitations under the License."),
    ("GPL-2.0-or-later", _GPL_HEADER.format(colon=";", either="; either", number=2)),
    ("GPL-3.0-or-later", _GPL_HEADER.format(colon=":", either=", either", number=3)),
)
#: Whole texts first: of a whole text and a sentence of it that fit alike, the whole text counts.
ALL_TEMPLATES = WHOLE_TEXTS + TEMPLATES
#: Templates of more bigrams are looked for by words first.
LONG = 40


def normal_words(text: str) -> list[str]:
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return [w for w in re.split(r"[^a-z0-9]+", folded) if w]


def bigrams(words: list[str]) -> list[str]:
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def size_bounds(m: int, threshold: float) -> tuple[int, int]:
    """Fewest and most bigrams of a line that can reach ``threshold`` with ``m`` template bigrams."""
    sizes = [n for n in range(1, int(m * (2 - threshold) / threshold) + 2) if 2 * min(n, m) >= threshold * (n + m)]
    return min(sizes), max(sizes)


def _needed(grams: list[str], threshold: float) -> list[str]:
    """Bigrams of which every passage that reaches ``threshold`` has one; the longest, as these are rare.

    Passages of n bigrams share at least ``threshold * (m + n) / 2`` and at most n, so ``m * t / (2 - t)`` of m.
    """
    least = size_bounds(len(grams), threshold)[0]
    return sorted(grams, key=lambda g: (-len(g), g))[: len(grams) - least + 1]


def _needed_words(grams: list[str], threshold: float) -> list[str]:
    """Words of which every passage that reaches ``threshold`` has one; the longest, as these are rare.

    Each word stands in some of the bigrams; once they stand in so many that too few others are left, they are enough.
    """
    least = size_bounds(len(grams), threshold)[0]
    left, chosen = set(grams), []
    for word in sorted({w for g in grams for w in g.split()}, key=lambda w: (-len(w), w)):
        if len(left) < least:
            break
        chosen.append(word)
        left -= {g for g in left if word in g.split()}
    return chosen


def notices(
    docs: DataFrame,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    threshold: float = THRESHOLD,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Notices within a line or over several lines: doc_id, line (from 0, where one starts), license, template, shared, bigrams, dice.

    The units are all passages of up to as many bigrams, repeated ones counted, as can reach the threshold; of
    passages that overlap the best counts, on a tie the earlier template, then the earlier passage. The best passages
    start and end with bigrams of their template, so only these are compared.

    Null and empty texts and texts of one word have no notices. Repeated rows are
    reported each for itself, a null id stays null, other columns of any name are
    ignored; an empty table gives an empty result. Whole texts are searched; the
    work grows with the square of the notices within one document.
    """
    known = [bigrams(normal_words(text)) for _, text in templates]
    bounds = [size_bounds(len(k), threshold) for k in known]
    # A bigram and the gaps around it, so that the texts without any chance are dropped by plain searches.
    needed = dict.fromkeys(f" {g} " for k in known if len(k) <= LONG for g in _needed(k, threshold))
    any_needed = F.lit(False)
    for g in needed:
        any_needed = any_needed | F.contains("flat", F.lit(g))
    # A long template would need hundreds of searches; one pass over the words of a text tells whether it has any of a set.
    rare = list(dict.fromkeys(w for k in known if len(k) > LONG for w in _needed_words(k, threshold)))
    if rare:
        any_needed = any_needed | F.arrays_overlap(F.split("flat", " "), F.array(*map(F.lit, rare)))
    folded = F.translate(docs[text_column].cast("string"), _UPPER, _UPPER.lower())
    flat = F.concat(F.lit(" "), F.regexp_replace(folded, "[^a-z0-9]+", " "), F.lit(" "))
    likely = (
        docs.select(docs[id_column].cast("bigint").alias("doc_id"), folded.alias("folded"), F.explode(F.array(flat)).alias("flat"))
        .filter(any_needed)
        .select("doc_id", "folded")
    )
    tokens = F.expr(
        r"flatten(transform(split(folded, '\n'), (l, i) -> transform(filter("
        r"split(regexp_replace(l, '[^a-z0-9]+', ' '), ' '), w -> w <> ''), w -> struct(w, i AS line))))"
    )
    pairs = F.expr(
        "transform(sequence(0, size(tokens) - 2), k -> struct("
        "concat(get(tokens, k).w, ' ', get(tokens, k + 1).w) AS g, k AS at, get(tokens, k).line AS line))"
    )
    every = F.array(*[F.lit(b) for b in dict.fromkeys(b for k in known for b in k)])
    forms = F.array(*[
        F.struct(F.lit(n).alias("n"), F.array(*map(F.lit, k)).alias("grams"), F.lit(b[0]).alias("least"), F.lit(b[1]).alias("most"))
        for n, (k, b) in enumerate(zip(known, bounds))
    ])
    # Only templates of which enough different bigrams stand in the text go on.
    near = (
        likely.select("doc_id", F.explode(F.array(tokens)).alias("tokens"))
        .filter("size(tokens) > 1")
        .select("doc_id", F.explode(F.array(pairs)).alias("pairs"))
        .withColumn("every", every)
        .select("doc_id", "pairs", F.explode(F.expr("array(array_intersect(transform(pairs, p -> p.g), every))")).alias("present"))
        .filter("size(present) > 0")
        .withColumn("forms", forms)
        .select("doc_id", "pairs", F.explode(F.expr(
            "array(filter(transform(forms, f -> struct(f, array_intersect(f.grams, present) AS own)), x -> size(x.own) >= x.f.least))"
        )).alias("near"))
        .filter("size(near) > 0")
    )
    # Place of the same bigram before each, -1 without: a passage's different bigrams are those without one inside it.
    earlier = (
        near.select("doc_id", "pairs", "near", F.explode(F.expr("array(sort_array(transform(pairs, p -> struct(p.g, p.at))))")).alias("equal"))
        .select("doc_id", "pairs", "near", F.explode(F.expr(
            "array(sort_array(transform(equal, (s, k) -> struct(s.at, if(get(equal, k - 1).g = s.g, get(equal, k - 1).at, -1) AS prev))))"
        )).alias("placed"))
    )
    hit = earlier.select("doc_id", "placed", F.explode(F.expr(
        "array(transform(near, x -> struct(x.f, transform(filter(pairs, p -> array_contains(x.own, p.g)),"
        " p -> struct(p.at, p.line, get(placed, p.at).prev AS prev)) AS hits)))"
    )).alias("close"))
    # For each template and each of its bigrams in the text, all passages that start there and are close enough. A passage
    # shares no more bigrams than it has hits, so its last hit is at least ``least - 1`` hits after its first.
    # Repeats are few, so they are picked out once for each start and taken off the lengths.
    most = "if(coalesce(get(x.hits, i + x.f.least - 1).at - h.at < x.f.most, false), x.f.most, 0)"
    measured = f"""
      transform(array(struct(
          filter(slice(placed, h.at + 1, {most}), v -> v.prev >= h.at) AS every,
          filter(slice(x.hits, i + 1, {most}), v -> v.prev >= h.at) AS own)), again ->
        transform(filter(slice(x.hits, i + x.f.least, {most}), e -> e.at - h.at < x.f.most), (e, j) -> transform(array(struct(
            e.at - h.at + 1 - size(filter(again.every, v -> v.at <= e.at)) AS bigrams,
            x.f.least + j - size(filter(again.own, v -> v.at <= e.at)) AS shared)), c ->
          struct(2.0D * c.shared / (c.bigrams + size(x.f.grams)) AS dice, -x.f.n AS rank,
            -h.at AS first, -e.at AS last, h.line AS line, c.shared AS shared, c.bigrams AS bigrams))[0]))[0]"""
    passages = f"flatten(transform(close, x -> flatten(transform(x.hits, (h, i) -> filter({measured}, b -> b.dice >= {threshold}D)))))"
    found = hit.select("doc_id", F.explode(F.expr(
        f"array(reverse(sort_array({passages})))"
    )).alias("found")).filter("size(found) > 0")
    kept = F.expr(
        "aggregate(found, slice(found, 1, 0), (kept, b) -> if(exists(kept, o -> -o.first <= -b.last + 1 AND -b.first <= -o.last + 1),"
        " kept, concat(kept, array(b))))"
    )
    names = F.array(*[F.lit(name) for name, _ in templates])
    return found.select("doc_id", F.explode(kept).alias("best")).select(
        "doc_id", F.col("best.line").alias("line"), F.element_at(names, 1 - F.col("best.rank")).alias("license"),
        (-F.col("best.rank")).alias("template"), F.col("best.shared").alias("shared"), F.col("best.bigrams").alias("bigrams"),
        F.col("best.dice").alias("dice"),
    )


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def notices_sql(templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The notices in ``documents`` as DuckDB SQL: all passages that start and end with bigrams of a template.

    Those with fewer such bigrams than the fewest that can reach the threshold are left out.
    """
    values = ", ".join("({}, '{}', '{}')".format(n, name, text.replace("'", "''")) for n, (name, text) in enumerate(templates))

    def words(text: str) -> str:
        folded = f"translate({text}, '{_UPPER}', '{_UPPER.lower()}')"
        return f"list_filter(string_split(regexp_replace({folded}, '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> '')"

    def pairs(words: str) -> str:
        return f"list_transform(range(1, len({words})::BIGINT), lambda i: {words}[i] || ' ' || {words}[i + 1])"

    return f"""
WITH templates AS (SELECT n, name, {words('content')} AS w FROM (VALUES {values}) AS v(n, name, content)),
known AS (
  SELECT *, floor(len(grams) * (2 - {threshold}) / {threshold})::BIGINT AS most,
    ceil(len(grams) * {threshold} / (2 - {threshold}) - 1e-9)::BIGINT AS least FROM (
    SELECT n, name, list_distinct({pairs('w')}) AS grams FROM templates)
),
split AS (SELECT row_number() OVER () AS doc, doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL),
cut AS (SELECT doc, doc_id, unnest(range(len(parts))) AS line, unnest(parts) AS content FROM split),
lines AS (SELECT doc, doc_id, line, {words('content')} AS w FROM cut),
texts AS (
  SELECT doc, any_value(doc_id) AS doc_id, flatten(list(w ORDER BY line)) AS w,
    flatten(list(list_transform(w, lambda x: line) ORDER BY line)) AS line
  FROM lines GROUP BY doc
),
paired AS (SELECT doc, doc_id, line, {pairs('w')} AS grams FROM texts WHERE len(w) > 1),
each AS (SELECT doc, unnest(grams) AS gram, unnest(range(len(grams))) AS spot FROM paired),
hits AS (SELECT e.doc, e.spot, k.n, row_number() OVER (PARTITION BY e.doc, k.n ORDER BY e.spot) AS nth
  FROM each e JOIN (SELECT n, unnest(grams) AS gram FROM known) k ON k.gram = e.gram),
spans AS (
  SELECT a.doc, a.n, a.spot AS head, b.spot AS tail FROM hits a JOIN hits b ON a.doc = b.doc AND a.n = b.n
  JOIN known k ON k.n = a.n WHERE b.nth - a.nth + 1 >= k.least AND b.spot - a.spot < k.most
),
measured AS (
  SELECT s.*, k.grams AS known, list_distinct(p.grams[s.head + 1:s.tail + 1]) AS d FROM spans s
  JOIN known k ON k.n = s.n JOIN paired p ON p.doc = s.doc
),
close AS (
  SELECT doc, n, head, tail, len(d) AS bigrams, len(list_intersect(d, known)) AS shared,
    2.0::DOUBLE * len(list_intersect(d, known)) / (len(d) + len(known)) AS dice FROM measured
),
ordered AS (
  SELECT doc, list([{{'head': head, 'tail': tail, 'n': n, 'shared': shared, 'bigrams': bigrams, 'dice': dice}}]
    ORDER BY dice DESC, n, head, tail) AS found
  FROM close WHERE dice >= {threshold} GROUP BY doc
),
kept AS (
  SELECT doc, unnest(list_reduce(found, lambda kept, b: CASE WHEN len(list_filter(kept,
    lambda o: o.head <= b[1].tail + 1 AND b[1].head <= o.tail + 1)) > 0 THEN kept ELSE list_concat(kept, b) END)) AS best FROM ordered
)
SELECT p.doc_id, p.line[k.best.head + 1]::INTEGER AS line, t.name AS license, k.best.n::INTEGER AS template,
  k.best.shared::INTEGER AS shared, k.best.bigrams::INTEGER AS bigrams, k.best.dice AS dice
FROM kept k JOIN paired p ON p.doc = k.doc JOIN templates t ON t.n = k.best.n"""
