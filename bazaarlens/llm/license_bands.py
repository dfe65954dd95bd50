"""License scans with MinHash bands over overlapping text windows, with DataFrame functions only.

Words are runs of ASCII letters and digits, in lower case; shingles are five words. Templates are put into classes by
their number of shingles, and for the class of up to L shingles a text is cut into windows of 2 L shingles, one every L:
whatever template of that class stands in a text lies whole in one of them. A window and a template meet in a band when
their least shingle under the band's hash is the same. If a window holds at least 80 % of a template of its class,
their Jaccard is at least ``LEAST_JACCARD``, so ``BANDS`` bands of one row miss it in fewer than 1 of 10,000 cases.
Candidates are then confirmed by exact containment of the template's shingles in the window.

A text that holds none of ``STEMS`` is not cut at all. This loses nothing: over 20 % of the shingles of each template
contain a stem (``templates`` checks it), so a text with at least 80 % of a template contains one.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WIDTH = 5
LEAST = 0.8
RATIO = 2  # a class takes templates of over L / RATIO and at most L shingles
LEAST_JACCARD = LEAST / RATIO / (2 + (1 - LEAST) / RATIO)
BANDS = 48  # (1 - LEAST_JACCARD) ** BANDS < 1e-4

# fixed values: public license notices and the usual one-line statements
TEMPLATES = [
    ("MIT line", "Released under the MIT License."),
    ("MIT line", "This project is licensed under the MIT License."),
    ("Apache-2.0 line", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0 line", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0 line", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-4.0 line", "Licensed under CC BY 4.0 International License."),
    ("CC-BY-SA-4.0 line", "Licensed under CC BY-SA 4.0 International License."),
    ("CC-BY-NC-4.0 line", "Licensed under CC BY-NC 4.0."),
    ("MPL-2.0 line", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software.",
    ),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License.",
    ),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        "General Public License for more details.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means.",
    ),
    # whole texts, without the copyright line that differs in each use
    (
        "MIT whole",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
        "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE.",
    ),
    (
        "BSD-2-Clause whole",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        'with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS '
        "OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, "
        "INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
        "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
        "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN "
        "ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "BSD-3-Clause whole",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS "
        'PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT '
        "NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO "
        "EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, "
        "OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, "
        "DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, "
        "STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, "
        "EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "ISC whole",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        'PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, "
        "OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION "
        "OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
        "SOFTWARE.",
    ),
    (
        "0BSD whole",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        'granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY "
        "SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
        "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH "
        "THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "Zlib whole",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote "
        "the original software. If you use this software in a product, an acknowledgment in the product documentation would "
        "be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be "
        "misrepresented as being the original software. 3. This notice may not be removed or altered from any source "
        "distribution.",
    ),
    (
        "BSL-1.0 whole",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        'accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, '
        "and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the "
        "Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire "
        "statement, including the above license grant, this restriction and the following disclaimer, must be included in all "
        "copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or "
        "derivative works are solely in the form of machine-executable object code generated by a source language processor. "
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE "
        "COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN "
        "THE SOFTWARE.",
    ),
    (
        "Unlicense whole",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author "
        "or authors of this software dedicate any and all copyright interest in the software to the public domain. We make "
        "this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend "
        "this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software "
        'under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING '
        "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
        "EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT "
        "OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
]
STEMS = ("licens", "software", "copyright", "permi", "distribut")


def template_words(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def templates(given: list[tuple[str, str]] = TEMPLATES) -> list[tuple[str, int, int, list[str]]]:
    """(license, number, class, distinct shingles) of each template; one that the filter could lose is refused."""
    out = []
    for number, (name, text) in enumerate(given):
        words = template_words(text)
        if len(words) < WIDTH:
            raise ValueError(f"{name} has fewer than {WIDTH} words")
        shingles = sorted({" ".join(words[i : i + WIDTH]) for i in range(len(words) - WIDTH + 1)})
        if sum(any(s in shingle for s in STEMS) for shingle in shingles) <= (1 - LEAST) * len(shingles):
            raise ValueError(f"too few shingles of {name} hold a stem")
        size = 1
        while size < len(words) - WIDTH + 1:
            size *= RATIO
        out.append((name, number, size, shingles))
    return out


def _band_values(h: Column, band: Column) -> Column:
    """The shingles' hashes under the function of a band."""
    return F.transform(h, lambda x: F.xxhash64(x, band))


def _known(spark: SparkSession, given: list) -> tuple[DataFrame, dict[tuple[int, int], list[int]]]:
    """Templates as a frame, and the least value of each class and band; as few as there are templates."""
    known = spark.createDataFrame(given, "license string, number int, size int, shingles array<string>")
    hashed = known.select("number", "size", F.transform("shingles", lambda s: F.xxhash64(s)).alias("h"))
    least = hashed.select("size", *[F.array_min(_band_values(F.col("h"), F.lit(b))).alias(f"b{b}") for b in range(BANDS)]).collect()
    values: dict[tuple[int, int], list[int]] = {}
    for row in least:
        for b in range(BANDS):
            values.setdefault((row["size"], b), []).append(row[f"b{b}"])
    return known, values


def scan(docs: DataFrame, given: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """One row per document and license found: doc_id, license, containment, first_word.

    ``containment`` is the largest share of a template's shingles that one window holds, ``first_word`` the first word
    of the first window that reaches it (from 0). NULL and empty texts and texts of fewer than five words hold no
    license. Rows with a NULL doc_id are scanned together, repeated rows of a doc_id are one document; other columns
    are ignored, an empty table gives no rows.
    """
    spark = docs.sparkSession
    made = templates(given)
    known, values = _known(spark, made)
    text = docs.select("doc_id", "text").where(F.lower("text").rlike("|".join(STEMS)))
    words = text.select("doc_id", F.transform(F.regexp_extract_all("text", F.lit("[A-Za-z0-9]+"), F.lit(0)), F.lower).alias("words"))
    words = words.where(F.size("words") >= WIDTH)
    count = F.size("words") - (WIDTH - 1)
    shingle = lambda i: F.concat_ws(" ", F.slice("words", i, F.lit(WIDTH)))
    hashed = words.withColumn("h", F.transform(F.sequence(F.lit(1), count), lambda i: F.xxhash64(shingle(i))))
    def in_class(values_b: Column, band: Column, size: int) -> Column:
        """Windows of a class whose least value in the band is that of a template."""
        wanted = F.get(F.array(*[F.array(*[F.lit(v) for v in values[size, b]]) for b in range(BANDS)]), band)
        last = F.greatest(F.floor((F.size(values_b) - 1) / size).cast("int"), F.lit(0))
        least = lambda k: F.array_min(F.slice(values_b, k * size + 1, F.lit(2 * size)))
        found = F.filter(F.sequence(F.lit(0), last), lambda k: F.array_contains(wanted, least(k)))
        return F.transform(found, lambda k: F.struct(F.lit(size).alias("size"), k.alias("k")))

    def in_band(h: Column, band: Column) -> Column:
        own = F.array(_band_values(h, band))
        return F.flatten(F.transform(own, lambda v: F.concat(*[in_class(v, band, size) for size in sorted({m[2] for m in made})])))

    def in_bands(h: Column) -> Column:
        return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda band: in_band(h, band)))

    # a value under a lambda is evaluated for each call; as the variable of a list of one it is evaluated once
    hits = F.array_distinct(F.flatten(F.transform(F.array("h"), in_bands)))
    per_band = hashed.select("doc_id", "words", hits.alias("hits"))
    window = lambda hit: F.struct(
        hit["size"].alias("size"),
        hit["k"].alias("k"),
        F.slice("words", hit["k"] * hit["size"] + 1, hit["size"] * 2 + (WIDTH - 1)).alias("words"),
    )
    windows = per_band.select("doc_id", F.explode(F.transform("hits", window)).alias("w")).select("doc_id", "w.*")
    shingles = F.transform(F.sequence(F.lit(1), F.size("words") - (WIDTH - 1)), shingle)
    windows = windows.where(F.size("words") >= WIDTH).withColumn("held", shingles).drop("words")
    # as many rows as there are templates
    joined = windows.join(F.broadcast(known), "size")
    share = F.size(F.array_intersect("shingles", "held")) / F.size("shingles")
    confirmed = joined.select("doc_id", "license", share.alias("containment"), (F.col("k") * F.col("size")).cast("long").alias("word"))
    confirmed = confirmed.where(F.col("containment") >= LEAST)
    best = confirmed.groupBy("doc_id", "license").agg(F.max(F.struct("containment", (-F.col("word")).alias("before"))).alias("best"))
    return best.select("doc_id", "license", F.col("best.containment").alias("containment"), (-F.col("best.before")).alias("first_word"))


def oracle(given: list[tuple[str, str]] = TEMPLATES) -> str:
    """The same matches by a plain join of shingles: a shingle at place p lies in the windows p // L and p // L - 1."""
    rows = ",\n".join(
        f"('{name}', {number}, {size}, '{shingle}', {len(shingles)})"
        for name, number, size, shingles in templates(given)
        for shingle in shingles
    )
    return f"""
WITH t(license, number, size, shingle, n) AS (VALUES {rows}),
w AS (SELECT doc_id, list_transform(regexp_extract_all(text, '[A-Za-z0-9]+'), lambda x: lower(x)) AS words FROM documents),
p AS (SELECT doc_id, words, unnest(range(0, len(words) - {WIDTH - 1})) AS p FROM w),
s AS (SELECT doc_id, p, array_to_string(words[p + 1 : p + {WIDTH}], ' ') AS shingle FROM p),
hit AS (SELECT doc_id, license, number, size, n, shingle, p // size AS k FROM s JOIN t USING (shingle)),
both_windows AS (SELECT * FROM hit UNION ALL SELECT doc_id, license, number, size, n, shingle, k - 1 FROM hit WHERE k > 0),
share AS (
  SELECT doc_id, license, number, size, k, count(DISTINCT shingle) / any_value(n) AS containment
  FROM both_windows GROUP BY ALL
)
SELECT doc_id, license, max(containment) AS containment,
  arg_max(k * size, (containment, -k * size))::BIGINT AS first_word
FROM share WHERE containment >= {LEAST} GROUP BY doc_id, license
"""
