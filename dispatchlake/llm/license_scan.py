"""License scans by diagonal voting, in DataFrame operations only.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. The rolling hashes of all
word k-grams of every text (two words for the base phrases, four for license texts) are joined, by hash
and by the words themselves, with the places where they stand in the templates. A gram at word p that
stands at place q of a template votes for the diagonal p - q. A base phrase stands where its diagonal has
all votes.

For a license text, each diagonal is merged with those up to DRIFT words behind it (words may have been put
in or left out) and the merged span is verified: of its votes only distinct places of the template count,
each at its first diagonal, and only if they stand in the template's order. The label is given where at
least COVERED of the template's grams are left. A phrase of a license that is repeated over and over has
few distinct places and no label.

score is 1 where a base phrase stands, else the largest share of a license text that one verified span has.
spans gives label, first word and word after the last of each base place and of the best span of each
license text that gives a label.

A row is identified while it is scanned, so null and repeated ids are rows of their own. Nulls and empty
texts have no words, null places, empty labels and score 0. Very long texts are one row until their grams
that stand in no template are gone. The templates are a table of fixed size, broadcast; votes are summed
before they are shuffled. Other columns are not needed and may have any name.
"""

from __future__ import annotations

import re
import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a gram: of the base phrases, of license texts.
BASE_GRAM, GRAM = 2, 4
DRIFT = 16
COVERED = 0.6

#: Fixed values. Label, phrase: their places are counted.
BASE = (
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
)
#: Fixed values. Label and public text: whole licenses where they are short, else the notice that is put into files.
TEXTS = (
    ("apache", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("apache", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License."""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"""),
    ("boost", """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following"""),
    ("cc-by-nc", """This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License"""),
    ("cc-by-nc", """Licensed under CC BY-NC 4.0"""),
    ("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program."""),
    ("gpl", """This program is free software you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"""),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"""),
    ("mpl", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. This notice may not be removed or altered from any source distribution."""),
)


def lowered(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def rolling(words: str) -> tuple[Column, Column]:
    """Hashes of the two and of the four words from each word of the array `words` on (shorter at its end)."""
    follow = lambda name, by: F.expr(f"slice({name}, {by + 1}, greatest(size({name}), 1))")
    pairs = F.zip_with(words, follow(words, 1), lambda a, b: F.xxhash64(a, b))
    two = "__pairs__"
    return pairs, F.zip_with(two, follow(two, 2), lambda a, b: F.xxhash64(a, b))


def with_grams(df: DataFrame) -> DataFrame:
    """`df` (a column words) with the hashes of its pairs and of its grams of four words."""
    pairs, fours = rolling("words")
    return df.withColumn("__pairs__", pairs).withColumn("__fours__", fours)


def templates(spark: SparkSession, texts: tuple[tuple[str, str], ...] = TEXTS) -> DataFrame:
    """template, label, base, k, grams (their number), q, gram (hash) and words of each gram of each template."""
    plain = lambda t: " ".join(re.findall(r"[0-9a-z\x80-\U0010FFFF]+", t.translate(_LOWER)))
    rows = [(n, label, n < len(BASE), BASE_GRAM if n < len(BASE) else GRAM, plain(text).split()) for n, (label, text) in enumerate((*BASE, *texts))]
    table = with_grams(spark.createDataFrame(rows, "template int, label string, base boolean, k int, words array<string>"))
    table = table.withColumn("grams", F.size("words") - F.col("k") + 1)
    each = table.select("template", "label", "base", "k", "grams", "words", F.posexplode(F.when(F.col("base"), F.col("__pairs__")).otherwise(F.col("__fours__"))).alias("q", "gram"))
    return each.filter("q < grams").withColumn("words", F.array_join(F.expr("slice(words, q + 1, k)"), " "))


_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def votes(docs: DataFrame, text_column: str = "text", texts: tuple[tuple[str, str], ...] = TEXTS) -> DataFrame:
    """row, doc_id, n_words, and for every diagonal of a template with votes: template, label, base, grams,
    diagonal and places (of the template). A row of `docs` without votes has one line without a template."""
    table = templates(docs.sparkSession, texts)
    known: dict[int, list[int]] = {BASE_GRAM: [], GRAM: []}
    for r in table.select("k", "gram").distinct().collect():  # of fixed size
        known[r["k"]].append(r["gram"])
    words = F.array_remove(F.split(lowered(F.coalesce(F.col(text_column), F.lit(""))), SEPARATOR), "")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", words.alias("words"))
    rows = with_grams(rows).withColumn("n_words", F.size("words").cast("long"))

    def stands(hashes: str, k: int) -> Column:
        """Only grams whose hash is in a template leave the row."""
        found = lambda x, i: F.when(x.isin(known[k]), F.struct(i.alias("p"), x.alias("gram"), F.array_join(F.slice("words", i + 1, k), " ").alias("words"), F.lit(k).alias("k")))
        return F.filter(F.transform(hashes, found), lambda s: s.isNotNull())

    each = rows.select("row", "doc_id", "n_words", F.explode_outer(F.concat(stands("__pairs__", BASE_GRAM), stands("__fours__", GRAM))).alias("x"))
    each = each.select("row", "doc_id", "n_words", "x.*")
    met = each.join(F.broadcast(table), ["gram", "words", "k"], "left")
    keys = ("row", "doc_id", "n_words", "template", "label", "base", "grams", (F.col("p") - F.col("q")).alias("diagonal"))
    return met.groupBy(*keys).agg(F.collect_set("q").alias("places"))


def _verified(merged: str) -> Column:
    """n (distinct places that stand in the template's order), start and end (of the first and after the
    last gram) of merged diagonals."""
    at = F.flatten(F.transform(merged, lambda d: F.transform(d["places"], lambda q: F.struct(q.alias("q"), (q + d["diagonal"]).alias("p")))))
    none = F.struct(F.lit(-1).alias("q"), F.lit(-1).alias("p"), F.lit(0).alias("n"), F.lit(-1).alias("start"))

    def step(s: Column, x: Column) -> Column:
        fits = (x["q"] > s["q"]) & (x["p"] > s["p"])
        return F.when(x["q"] == s["q"], s).otherwise(
            F.struct(x["q"].alias("q"), F.greatest(s["p"], x["p"]).alias("p"), (s["n"] + fits.cast("int")).alias("n"), F.when(s["start"] < 0, x["p"]).otherwise(s["start"]).alias("start"))
        )

    return F.aggregate(F.array_sort(at), none, step)


def scan(docs: DataFrame, text_column: str = "text", texts: tuple[tuple[str, str], ...] = TEXTS) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and spans of every row of `docs`."""
    voted = votes(docs, text_column, texts)
    along = Window.partitionBy("row", "template")
    ahead = along.orderBy("diagonal").rangeBetween(0, DRIFT)
    merged = voted.withColumn("merged", F.when(~F.col("base"), F.collect_list(F.struct("diagonal", "places")).over(ahead)))
    told = merged.withColumn("v", F.when(F.col("merged").isNotNull(), _verified("merged")))
    told = told.withColumn("share", F.col("v.n") / F.col("grams"))
    told = told.withColumn("best", F.max(F.struct("share", -F.col("diagonal"))).over(along))
    place = F.col("base") & (F.size("places") == F.col("grams"))
    whole = ~F.col("base") & (F.col("share") >= COVERED)
    span = F.when(place, F.struct("label", F.col("diagonal").alias("start"), (F.col("diagonal") + F.col("grams") + BASE_GRAM - 1).alias("end")))
    span = span.when(whole & (F.col("best") == F.struct("share", -F.col("diagonal"))), F.struct("label", F.col("v.start").alias("start"), (F.col("v.p") + GRAM).alias("end")))
    labels = lambda which: F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")
    start = F.when(place, F.col("diagonal").cast("long"))
    return told.groupBy("row", "doc_id", "n_words").agg(
        F.count_if(place).alias("n_base"),
        F.min(start).alias("first_word"),
        F.max(start).alias("last_word"),
        labels(place).alias("base_labels"),
        labels(place | whole).alias("labels"),
        F.coalesce(F.max(F.when(place, 1.0).otherwise(F.col("share"))), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(span)).alias("spans"),
    ).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")


def op10_license_scan(spark, sf_dir: str) -> DataFrame:
    """The contract's columns for every row of documents."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("spans")
