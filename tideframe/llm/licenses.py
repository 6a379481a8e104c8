"""License scan by canonical digests, in built-in expressions only.

A text is brought to canonical form: copyright lines go, letters become lower case, whatever is no letter or digit
becomes one space, equivalent spellings become one. The digest of the whole canonical text is looked up among the
digests of known license texts. Units are the whole document and each of its lines, as a notice often is one line of a file.
The known digests are a fixed, small table, so this join needs no shuffle of texts.

Defined cases: null and empty texts, and texts that are copyright lines only, have no license; a license named by
several lines counts once in ``licenses`` and each time in ``n_lines``; rows of one id are reported together,
one result row for each input row; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

COPYRIGHT = r"(?im)^[ \t*#/;>-]*(?:copyright[ \t]*(?:\(c\)|©|[0-9<\[:])|\(c\)|©|all rights reserved)[^\n]*$"
#: Spellings that count as equal, applied to the canonical form in this order.
SPELLINGS = (
    ("licenc", "licens"),
    ("organis", "organiz"),
    ("authoris", "authoriz"),
    ("favour", "favor"),
    ("acknowledgement", "acknowledgment"),
    ("non commercial", "noncommercial"),
    ("sub licens", "sublicens"),
    ("copyright owner", "copyright holder"),
    ("https ", "http "),
    (" version ", " v "),
    (" v2 0", " v 2 0"),
    (" v3", " v 3"),
)

_PERMISSION = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the Software."
)
_MIT_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
    "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH "
    "THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
    "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY "
    "DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
    "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_ISC_PERMISSION = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
#: Known license texts and notices by SPDX identifier.
KNOWN = (
    ("MIT", f"MIT License {_PERMISSION} {_MIT_WARRANTY}"),
    ("MIT", f"The MIT License (MIT) {_PERMISSION} {_MIT_WARRANTY}"),
    ("MIT", f"{_PERMISSION} {_MIT_WARRANTY}"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", f"ISC License {_ISC_PERMISSION}, provided that the above copyright notice and this permission notice appear in all copies. {_ISC_WARRANTY}"),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("0BSD", f"{_ISC_PERMISSION}. {_ISC_WARRANTY}"),
    ("0BSD", "SPDX-License-Identifier: 0BSD"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License").'),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("GPL-3.0-or-later", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("LGPL-3.0-only", "SPDX-License-Identifier: LGPL-3.0-only"),
    ("AGPL-3.0-only", "SPDX-License-Identifier: AGPL-3.0-only"),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def canonical(text: Column) -> Column:
    """Canonical form of a text."""
    plain = F.regexp_replace(F.lower(F.regexp_replace(text, COPYRIGHT, " ")), "[^a-z0-9]+", " ")
    for found, put in SPELLINGS:
        plain = F.replace(plain, F.lit(found), F.lit(put))
    return F.trim(plain)


def known_digests(spark: SparkSession) -> DataFrame:
    """(digest, license) of the known texts, by the same canonical form."""
    known = spark.createDataFrame(list(KNOWN), "license string, text string")
    return known.select(F.md5(canonical(F.col("text"))).alias("digest"), "license").dropDuplicates(["digest"])


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, text_license (of the whole text, or null), licenses (of its lines, sorted, comma-joined), n_lines."""
    text = F.coalesce(F.col("text"), F.lit(""))
    units = F.concat(
        F.array(F.struct(F.lit(True).alias("whole"), text.alias("unit"))),
        F.transform(F.split(text, "\n"), lambda line: F.struct(F.lit(False).alias("whole"), line.alias("unit"))),
    )
    rows = docs.select("doc_id", F.explode(units).alias("u")).select("doc_id", "u.whole", F.md5(canonical(F.col("u.unit"))).alias("digest"))
    found = (
        rows.join(F.broadcast(known_digests(docs.sparkSession)), "digest")  # as many rows as KNOWN
        .groupBy("doc_id")
        .agg(
            F.max(F.when(F.col("whole"), F.col("license"))).alias("text_license"),
            F.array_join(F.sort_array(F.collect_set(F.when(~F.col("whole"), F.col("license")))), ",").alias("licenses"),
            F.count_if(~F.col("whole")).alias("n_lines"),
        )
        .withColumnRenamed("doc_id", "found_id")
    )
    joined = docs.select("doc_id").join(found, F.col("doc_id").eqNullSafe(F.col("found_id")), "left")
    return joined.select("doc_id", "text_license", F.coalesce("licenses", F.lit("")).alias("licenses"), F.coalesce("n_lines", F.lit(0)).alias("n_lines"))
