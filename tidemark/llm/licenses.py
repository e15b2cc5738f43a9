"""Licence notices in documents: Dice coefficient over word bigrams."""

import math
from collections import Counter
from functools import reduce
from operator import and_, or_
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged, texts

LEAST = 0.8  # Dice coefficient of a match

# --- Fixed values: public licence notices and texts, one template each ---
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    (
        "apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the "
        'License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ),
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
    ),
    (
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/.",
    ),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    (
        "gpl-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ),
    ("lgpl-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("agpl-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    (
        "cc-by-4.0",
        "This work is licensed under the Creative Commons Attribution 4.0 International License.",
    ),
    (
        "cc-by-sa-4.0",
        "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International "
        "License.",
    ),
    (
        "cc-by-nc-4.0",
        "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 "
        "International License.",
    ),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright to this work."),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain.",
    ),
    ("proprietary", "All rights reserved."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial "
        'portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, '
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS "
        "FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
        "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE "
        "USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: 1. Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution. 3. Neither the name of the copyright holder nor "
        "the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE "
        'COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, '
        "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
        "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR "
        "ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, "
        "BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR "
        "PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
        "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY "
        "OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        'permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR '
        "DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
        "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
        "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
        "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event "
        "will the authors be held liable for any damages arising from the use of this software. "
        "Permission is granted to anyone to use this software for any purpose, including commercial "
        "applications, and to alter it and redistribute it freely, subject to the following "
        "restrictions: 1. The origin of this software must not be misrepresented; you must not claim "
        "that you wrote the original software. If you use this software in a product, an "
        "acknowledgment in the product documentation would be appreciated but is not required. "
        "2. Altered source versions must be plainly marked as such, and must not be misrepresented "
        "as being the original software. 3. This notice may not be removed or altered from any "
        "source distribution.",
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to "
        "copy, modify, publish, use, compile, sell, or distribute this software, either in source "
        "code form or as a compiled binary, for any purpose, commercial or non-commercial, and by "
        "any means.",
    ),
    (
        "apache-2.0",
        "Grant of Copyright License. Subject to the terms and conditions of this License, each "
        "Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, "
        "royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, "
        "publicly display, publicly perform, sublicense, and distribute the Work and such Derivative "
        "Works in Source or Object form.",
    ),
    (
        "gpl-3.0",
        "The GNU General Public License is a free, copyleft license for software and other kinds of "
        "works.",
    ),
    (
        "gpl-3.0",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
        "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
        "See the GNU General Public License for more details.",
    ),
]
# --- End of fixed values ---

NOT_WORD = "[^a-z0-9]+"
LOW, HIGH = LEAST / (2 - LEAST), (2 - LEAST) / LEAST  # sizes that can match, by the template's


def bigrams(text: str) -> list[str]:
    words = "".join(c if c.isalnum() and c.isascii() else " " for c in text.lower()).split()
    return [f"{a} {b}" for a, b in zip(words, words[1:])]


def template_rows() -> list[tuple[int, str, int, str, int]]:
    """Template number, licence, bigrams, bigram, its count."""
    rows = []
    for number, (licence, text) in enumerate(TEMPLATES):
        pairs = bigrams(text)
        rows += [(number, licence, len(pairs), p, n) for p, n in sorted(Counter(pairs).items())]
    return rows


def least_common(size: int) -> int:
    """Bigrams that a range must share with a template of that size to match it."""
    return math.ceil(LOW * size - 1e-9)


def reach(size: int) -> int:
    """Bigrams in the longest range that can match a template of that size."""
    return math.floor(HIGH * size + 1e-9)


def telling_words() -> tuple[list[str], list[list[str]]]:
    """Words of which any text that matches a template holds one, and sets of words of which it
    else holds a whole one.

    Of a template's bigrams without a telling word fewer than a match needs are left, or just
    as many: then such a match has them all. Long words that are in many bigrams come first.
    """
    single: list[str] = []
    together: list[list[str]] = []
    for _, text in TEMPLATES:
        pairs = bigrams(text)
        least = least_common(len(pairs))
        while len(left := [p for p in pairs if not set(p.split()) & set(single)]) >= least:
            found = Counter(w for p in left for w in set(p.split()))
            best = max(found, key=lambda w: (min(len(w), 7), found[w], w))
            if len(left) == least and len(best) < 5:
                together.append(sorted({w for p in left for w in p.split()}))
                break
            single.append(best)
    return single, together


def _lower(text: Column) -> Column:
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def hits(docs: DataFrame) -> DataFrame:
    """Where a template's bigrams stand in texts: ``rid``, ``doc_id``, ``at``, ``number``, ...

    Only texts that hold a telling word are taken apart, and written first, so that a row
    keeps its key.
    """
    single, together = telling_words()

    def telling(text):
        holds = lambda w: F.contains(text, F.lit(w))
        return reduce(or_, [*map(holds, single), *[reduce(and_, map(holds, ws)) for ws in together]])

    rows = staged(
        texts(docs)
        .filter(F.exists(F.array(F.lower("text")), telling))  # lower-cased once for all words
        .select(
            F.monotonically_increasing_id().alias("rid"), "doc_id", _lower(F.col("text")).alias("lower")
        ),
        "telling",
    )
    words = F.filter(F.split("lower", NOT_WORD), lambda w: w != "")
    pairs = F.transform(
        F.sequence(F.lit(1), F.size("words") - 1),
        lambda i: F.concat_ws(" ", F.get("words", i - 1), F.get("words", i)),
    )
    templates = docs.sparkSession.createDataFrame(
        [(*r, least_common(r[2]), reach(r[2])) for r in template_rows()],
        "number int, licence string, size int, pair string, held int, least int, reach int",
    )
    return (
        rows.select("rid", "doc_id", words.alias("words"))
        .filter(F.size("words") > 1)
        .select("rid", "doc_id", F.posexplode(pairs).alias("at", "pair"))
        .join(F.broadcast(templates), "pair")
    )


def matches(docs: DataFrame) -> DataFrame:
    """Ranges of bigrams that match a template: ``rid``, ``doc_id``, ``number``, ``licence``,
    ``start``, ``end`` (inclusive) and ``dice``.

    A range starts and ends at a template's bigram; no other range of the text can have a
    higher coefficient than the range between its first and last such bigram. Of a start's
    ranges the best is kept, the shortest of equal ones. A start from which too few of the
    template's bigrams are in reach is left out before any range is built; starts and bigrams
    meet by blocks of the template's reach, so the work follows the text's length.
    """
    found = staged(hits(docs), "hits")
    # Positions in millionths of the reach, so that one frame serves all templates.
    scaled = F.expr("cast(at as bigint) * 1000000 div reach")
    ahead = Window.partitionBy("rid", "number").orderBy(scaled).rangeBetween(0, 999_999)
    block = F.floor(F.col("at") / F.col("reach"))
    starts = (
        found.withColumn("ahead", F.count("*").over(ahead))
        .filter(F.col("ahead") >= F.col("least"))
        .select(
            "rid",
            "number",
            F.col("at").alias("start"),
            F.explode(F.array(block, block + 1)).alias("block"),
        )
        .distinct()
    )
    met = (
        found.withColumn("block", block)
        .join(starts, ["rid", "number", "block"])
        .filter(F.col("at").between(F.col("start"), F.col("start") + F.col("reach") - 1))
    )
    same = Window.partitionBy("rid", "number", "start", "pair").orderBy("at")
    upto = Window.partitionBy("rid", "number", "start").orderBy("at")
    grown = (
        met.withColumn("counts", (F.row_number().over(same) <= F.col("held")).cast("int"))
        .withColumn("common", F.sum("counts").over(upto.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn(
            "dice",
            2.0 * F.col("common") / (F.col("at") - F.col("start") + 1 + F.col("size")),
        )
        .filter(F.col("dice") >= LEAST)
    )
    best = F.max(F.struct("dice", (-F.col("at")).alias("last")))
    return (
        grown.groupBy("rid", "doc_id", "number", "licence", "start")
        .agg(best.alias("best"))
        .select(
            "rid",
            "doc_id",
            "number",
            "licence",
            "start",
            (-F.col("best.last")).alias("end"),
            F.col("best.dice").alias("dice"),
        )
    )


def scan(docs: DataFrame) -> DataFrame:
    """A row for each document and licence it shows: ``doc_id``, ``licence``, ``notices``
    (places that match) and ``dice`` (the best).

    A notice is found wherever it stands in a text, in a line, over lines, or between other
    words: a place is a range of words whose bigrams (as a bag) have a Dice coefficient of
    ``LEAST`` or more with a template's. Sizes alone bound the coefficient, so only ranges of
    ``LEAST / (2 - LEAST)`` to ``(2 - LEAST) / LEAST`` times a template's bigrams can match it.
    Of overlapping ranges the one with the higher coefficient counts, then the longer, the
    earlier, the first template; one that is beaten so doesn't count. Templates are a fixed list
    and are broadcast.

    Null and empty texts show nothing; an empty table gives an empty result. Rows repeated
    under one id are counted together; other columns are not read.
    """
    found = staged(matches(docs), "matches")
    width = reach(max(len(bigrams(text)) for _, text in TEMPLATES))
    order = ("dice", "length", "start", "number")
    ranked = found.withColumn("length", F.col("end") - F.col("start"))
    blocks = F.array_distinct(
        F.array(F.floor(F.col("start") / width), F.floor(F.col("end") / width))
    )
    own = ranked.withColumn("block", F.explode(blocks))
    other = own.select(
        "rid", "block", *[F.col(c).alias(f"_{c}") for c in ("end", *order)]
    )
    beaten = (
        own.join(other, ["rid", "block"])
        .filter((F.col("_start") <= F.col("end")) & (F.col("_end") >= F.col("start")))
        .filter(
            F.struct("_dice", "_length", -F.col("_start"), -F.col("_number"))
            > F.struct("dice", "length", -F.col("start"), -F.col("number"))
        )
        .select("rid", "number", "start")
    )
    return (
        found.join(beaten, ["rid", "number", "start"], "left_anti")
        .groupBy("doc_id", "licence")
        .agg(F.count("*").alias("notices"), F.max("dice").alias("dice"))
    )


def oracle() -> str:
    """The same in SQL."""
    values = ", ".join(
        f"({number}, '{licence}', {size}, '{pair}', {held}, {least_common(size)}, {reach(size)})"
        for number, licence, size, pair, held in template_rows()
    )
    return f"""
WITH templates(number, licence, size, pair, held, least, reach) AS (VALUES {values}),
worded AS (
    SELECT row_number() OVER () AS rid, doc_id,
           [w for w in string_split_regex(
               translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}'), '{NOT_WORD}')
            if w <> ''] AS words
    FROM documents
), pairs AS (
    SELECT rid, doc_id, unnest(range(0, len(words) - 1)) AS pos,
           unnest([words[i] || ' ' || words[i + 1] for i in range(1, len(words))]) AS pair
    FROM worded WHERE len(words) > 1
), hits AS (SELECT * FROM pairs JOIN templates USING (pair)),
starts AS (
    SELECT h.rid, h.number, h.pos AS start FROM hits h JOIN hits o
        ON h.rid = o.rid AND h.number = o.number AND o.pos BETWEEN h.pos AND h.pos + h.reach - 1
    GROUP BY h.rid, h.number, h.pos, h.least HAVING count(*) >= h.least
), met AS (
    SELECT h.*, s.start,
           CASE WHEN row_number() OVER (PARTITION BY h.rid, h.number, start, pair ORDER BY pos) <= held
                THEN 1 ELSE 0 END AS counts
    FROM hits h JOIN starts s
        ON h.rid = s.rid AND h.number = s.number AND h.pos BETWEEN s.start AND s.start + h.reach - 1
), grown AS (
    SELECT *, 2.0::DOUBLE * sum(counts) OVER (
               PARTITION BY rid, number, start ORDER BY pos ROWS UNBOUNDED PRECEDING)
               / (pos - start + 1 + size) AS dice
    FROM met
), best AS (
    SELECT rid, doc_id, number, licence, start, pos AS "end", dice,
           row_number() OVER (PARTITION BY rid, number, start ORDER BY dice DESC, pos) AS place
    FROM grown WHERE dice >= {LEAST}
), found AS (SELECT *, "end" - start AS length FROM best WHERE place = 1)
SELECT doc_id, licence, count(*) AS notices, max(dice) AS dice
FROM found f
WHERE NOT EXISTS (
    SELECT 1 FROM found o
    WHERE o.rid = f.rid AND o.start <= f."end" AND o."end" >= f.start
      AND (o.dice, o.length, -o.start, -o.number) > (f.dice, f.length, -f.start, -f.number))
GROUP BY doc_id, licence
"""
