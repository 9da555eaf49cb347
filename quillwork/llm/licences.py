"""Licence scan in native expressions: TF-IDF cosine of notices and licence files to templates, inheritance by path.

A file is looked at in units: the whole text, its leading block of comments, each paragraph, each line, and each run of
neighbouring lines with licence terms; marks of comments go first. Units and templates are sparse vectors of terms with
the weight (1 + ln tf) * ln((1 + N) / (1 + df)), N and df counted over all files. A file's own licence is the template
with the largest cosine to one of its units. A file without one inherits that of the nearest directory above it that
has a licence file, by joins on the path.

Only units that can reach the least cosine have their vectors built. By Cauchy and Schwarz a unit that shares none of a
template's heaviest terms, whose squares make up all but least_cosine squared of the template's squared norm, is below
it; so units without one of these terms are left out, and nothing is lost.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, maybe_broadcast, share, spread_join, stash, with_rid

_WARRANTY = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
_PERMISSION = 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.'
_BSD_START = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_NAMES = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
_ISC_END = 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'


def _gnu(name: str, version: str) -> str:
    return f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details. You should have received a copy of the GNU {name} along with this program. If not, see <https://www.gnu.org/licenses/>."


def _gnu_title(name: str, version: str, date: str) -> str:
    return f"GNU {name.upper()} Version {version}, {date} Copyright (C) Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."


#: The public wording of licence notices, the texts of short licences and the titles of long ones.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "The MIT License (MIT) " + _PERMISSION + " " + _WARRANTY),
    ("MIT", _PERMISSION),
    ("ISC", _ISC + " " + _ISC_END),
    ("ISC", _ISC),
    ("BSD-2-Clause", _BSD_START + " " + _BSD_END),
    ("BSD-3-Clause", _BSD_START + " " + _BSD_NAMES + " " + _BSD_END),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted under the BSD 3-Clause License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", _gnu("General Public License", "3")),
    ("GPL-3.0", _gnu_title("General Public License", "3", "29 June 2007")),
    ("GPL-2.0", _gnu("General Public License", "2")),
    ("GPL-2.0", _gnu_title("General Public License", "2", "June 1991")),
    ("LGPL-3.0", _gnu("Lesser General Public License", "3")),
    ("LGPL-3.0", _gnu_title("Lesser General Public License", "3", "29 June 2007")),
    ("AGPL-3.0", _gnu("Affero General Public License", "3")),
    ("AGPL-3.0", _gnu_title("Affero General Public License", "3", "19 November 2007")),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "Mozilla Public License Version 2.0 1. Definitions"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License. http://creativecommons.org/licenses/by/4.0/"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License. http://creativecommons.org/licenses/by-sa/4.0/"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License. http://creativecommons.org/licenses/by-nc/4.0/"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work. CC0 1.0 Universal Public Domain Dedication http://creativecommons.org/publicdomain/zero/1.0/"),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote the original software. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. This notice may not be removed or altered from any source distribution."),
]
#: What a line of a comment starts with, and may end with.
COMMENT = r"^\s*(?://+[/!]?|/\*+!?|\*+/?|#+!?|;+|--+|%+|<!--+|\{-|\(\*|\"\"\"|''')"
COMMENT_END = r"\s*(?:\*+/|--+>|-\}|\*\)|\"\"\"|''')\s*$"
#: Separators of terms: ASCII white space and punctuation.
APART = "\t\n\x0b\x0c\r" + "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())


@dataclass(frozen=True)
class Settings:
    least_cosine: float = 0.6
    file_cosine: float = 0.85  # a file whose whole text reaches it is a licence file
    template_terms: int = 20_000  # the templates' terms at most, which go to all tasks


def terms(text: Column) -> Column:
    """Lower-cased terms in order, cut at ASCII white space and punctuation."""
    t = F.btrim(F.translate(F.lower(text), APART, " " * len(APART)))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, " +"))


def units(text: Column, keys: Column) -> Column:
    """The units of a text that have one of the keys: distinct, the whole text first."""
    plain = lambda x: F.regexp_replace(F.regexp_replace(x, COMMENT, ""), COMMENT_END, "")
    has = lambda x: F.arrays_overlap(terms(x), keys)
    no_lines = F.array().cast("array<string>")

    def of(raw: Column) -> Column:
        def of_lines(lines: Column) -> Column:
            whole = F.array_join(lines, "\n")
            # the leading block: lines of comments, or blank ones among them
            body = F.transform(raw, lambda x, i: F.when(x.rlike(COMMENT) | x.rlike(r"^\s*$"), F.size(raw)).otherwise(i))
            header = F.array_join(F.slice(lines, 1, F.array_min(body)), "\n")
            # runs of lines with keys: a line without one ends a run
            marked = F.transform(lines, lambda x: F.when(has(x), x))
            runs = F.split(F.array_join(F.transform(marked, lambda x: F.coalesce(x, F.lit("\x00"))), "\n"), "\x00")
            some = F.concat(F.array(whole, header), F.split(whole, r"\n[ \t\r]*\n\s*"), runs, F.filter(marked, lambda x: x.isNotNull()))
            return F.array_distinct(F.filter(some, lambda x: (F.btrim(x) != "") & has(x)))

        return let(F.transform(raw, plain), of_lines)

    return F.coalesce(let(F.split(F.coalesce(text, F.lit("")), "\n"), of), no_lines)


def weights(tf: DataFrame, idf: DataFrame, key: list[str]) -> DataFrame:
    """Add w to (key, term, tf); idf: term, df, idf. Terms of many files are dealt over several tasks."""
    most = share(tf.count(), tf.sparkSession)
    counts = idf.select("term", F.col("df").alias("_n"))
    return spread_join(tf, idf.select("term", "idf"), ["term"], counts, most).withColumn("w", (1 + F.log("tf")) * F.col("idf")).select(*key, "term", "w")


def scan(files: DataFrame, templates: DataFrame, s: Settings = Settings()) -> DataFrame:
    """One row per file: the columns of files but text, own_licence, cosine, licence, inherited_from.

    files: _rid (unique), path, text, and others. own_licence is the template with the largest cosine (rounded to six
    places) to a unit of the file, ties to the smaller name; null below least_cosine, as is cosine. A licence file is
    one whose whole text reaches file_cosine, or one with an own licence whose name is LICENSE, LICENCE or COPYING. A
    directory's licence is the one that most of its own licence files have, ties to the smaller name. licence is the
    own one, else that of the nearest directory above; inherited_from names that directory. Null, empty and wordless
    texts have no units; a null path has no directory. Repeated rows are scanned one by one. Columns of files with the
    name of an added one are replaced. Empty tables give an empty result, no templates give no licences.
    """
    spark = files.sparkSession
    own_columns = [c for c in files.columns if c not in ("text", "own_licence", "cosine", "licence", "inherited_from")]
    text = F.coalesce(F.col("text"), F.lit(""))
    n = files.count()
    df = files.select(F.explode(F.array_distinct(terms(text))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = stash(df.withColumn("idf", F.log((1.0 + n) / (1.0 + F.col("df")))), "idf")
    # a row for each wording of a template
    worded = templates.select("name", F.xxhash64("name", "notice").alias("v"), "notice").distinct()
    tt = worded.select("name", "v", F.explode(terms(F.col("notice"))).alias("term")).groupBy("name", "v", "term").agg(F.count(F.lit(1)).alias("tf"))
    unseen = F.log(F.lit(1.0 + n))
    tw = stash(tt.join(idf, "term", "left").withColumn("tw", (1 + F.log("tf")) * F.coalesce("idf", unseen)).filter("tw > 0").select("name", "v", "term", "tw"), "templates")
    norms = tw.groupBy("v").agg(F.sqrt(F.sum(F.col("tw") * F.col("tw"))).alias("tnorm"))
    lists = tw.groupBy("v").agg(F.array_sort(F.collect_list(F.struct(F.negative("tw").alias("x"), "term"))).alias("l"), F.sum(F.col("tw") * F.col("tw")).alias("all"))
    # the heaviest terms, until those left are too light to reach the least cosine by themselves
    before = lambda i: F.aggregate(F.slice("l", 1, i), F.lit(0.0), lambda t, x: t + x["x"] * x["x"])
    heavy = F.filter(F.col("l"), lambda x, i: F.col("all") - before(i) > (s.least_cosine - 1e-6) ** 2 * F.col("all") * (1 - 1e-9))
    found = lists.select(F.explode(heavy).alias("x")).select("x.term").distinct().limit(s.template_terms + 1).collect()  # of the templates only
    if len(found) > s.template_terms:
        raise ValueError(f"templates with more than {s.template_terms} heavy terms")
    keys = F.array(*[F.lit(r["term"]) for r in found]).cast("array<string>")
    some = files.select("_rid", "path", text.alias("text")).filter(F.arrays_overlap(terms(F.col("text")), keys))
    unit = stash(some.select("_rid", "path", F.posexplode(units(F.col("text"), keys)).alias("u", "unit")), "units")
    tf = stash(unit.select("_rid", "u", F.explode(terms(F.col("unit"))).alias("term")).groupBy("_rid", "u", "term").agg(F.count(F.lit(1)).alias("tf")), "terms")
    vec = stash(weights(tf, idf, ["_rid", "u"]), "vectors")
    norm = vec.groupBy("_rid", "u").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dot = vec.join(maybe_broadcast(tw, 100_000, F.octet_length("term")), "term").groupBy("_rid", "u", "name", "v").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
    cos = dot.join(norm, ["_rid", "u"]).join(maybe_broadcast(norms, 100_000), "v").withColumn("cosine", F.round(F.col("dot") / (F.col("norm") * F.col("tnorm")), 6)).filter(F.col("cosine") >= s.least_cosine)
    best = F.min(F.struct(F.negative("cosine").alias("x"), "name"))
    whole = F.max((F.col("u") == 0) & (F.col("cosine") >= s.file_cosine))
    each = stash(cos.groupBy("_rid").agg(best.alias("b"), whole.alias("w")), "own")
    own = each.select("_rid", F.negative("b.x").alias("cosine"), F.col("b.name").alias("own_licence"), F.col("w").alias("alone"))
    paths = unit.filter("u = 0").select("_rid", "path")
    base = F.element_at(F.split("path", "/"), -1)
    up = lambda p: F.regexp_replace(p, "/[^/]*$", "")
    licence_file = F.col("alone") | base.rlike(r"(?i)^(licen[cs]e|copying)(\..*)?$")
    votes = own.join(paths, "_rid").filter(licence_file & F.col("path").contains("/")).groupBy(up(F.col("path")).alias("dir"), "own_licence").agg(F.count(F.lit(1)).alias("k"))
    dirs = stash(votes.groupBy("dir").agg(F.min(F.struct(F.negative("k").alias("x"), "own_licence")).alias("b")).select("dir", F.col("b.own_licence").alias("dir_licence")), "dirs")
    # each directory of files looks up all directories above itself once; files then join their own directory
    depth = lambda p: F.size(F.split(p, "/"))
    homes = stash(files.filter(F.col("path").contains("/")).groupBy(up(F.col("path")).alias("_home")).agg(F.count(F.lit(1)).alias("_n")), "homes")
    above = homes.select("_home", F.explode(F.transform(F.sequence(F.lit(1), depth(F.col("_home"))), lambda i: F.array_join(F.slice(F.split("_home", "/"), 1, i), "/"))).alias("dir"))
    near = above.join(dirs, "dir").groupBy("_home").agg(F.max(F.struct(depth(F.col("dir")).alias("d"), "dir", "dir_licence")).alias("b")).select("_home", F.col("b.dir").alias("_from"), F.col("b.dir_licence").alias("_above"))
    out = files.select(*own_columns, up(F.col("path")).alias("_home")).join(own.select("_rid", "own_licence", "cosine"), "_rid", "left")
    out = spread_join(out, near, ["_home"], homes, share(n, spark), "left")  # a directory may hold very many files
    inherits = F.col("own_licence").isNull()
    return out.select(*own_columns, "own_licence", "cosine", F.coalesce("own_licence", "_above").alias("licence"), F.when(inherits, F.col("_from")).alias("inherited_from"))


def template_rows(spark) -> DataFrame:
    return spark.createDataFrame(TEMPLATES, "name string, notice string")


def query(spark, sf_dir: str) -> DataFrame:
    """Documents as files: source / thousand of ids / hundred of ids / id. A null doc_id leaves the last three out."""
    docs = with_rid(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source"))
    number = F.col("doc_id")
    path = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.floor(number / 1000).cast("string"), F.floor(number / 100).cast("string"), number.cast("string"))
    got = scan(docs.select("_rid", "doc_id", path.alias("path"), "text"), template_rows(spark))
    return got.drop("_rid")
