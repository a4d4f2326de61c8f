"""License scans by diagonal voting, in DataFrame operations only.

Words: A-Z lower-cased, runs outside the ASCII separators. Every rolling gram of
``GRAM`` words of every document is hashed and joined to the template positions
that hold the same gram; the template table is a fixed list, so its broadcast is
bounded by the code. Hits are counted per (document, template, diagonal), the
diagonal being document position minus template position. Diagonals at most
``SLACK`` apart are merged (words put in or left out shift later hits to a
neighbouring diagonal). A merged run is verified: every key phrase of the template
(the words that tell it from its relatives) must stand in one diagonal's hits
word by word; the template's words that the hits cover, over its size and the words
put in between them, must reach ``COVER``; and the span may not be longer than
``STRETCH`` times the template. A longer run is split: its diagonals with fewer than
a ``WEAK``-th of the strongest one's votes (a passage said over and over beside the
notice) are merged apart from the others, and what is still too long stands as
single diagonals, none of which is longer than the template. Verified spans are taken by most words covered
(then best cover, then name), and one that overlaps a span taken before is dropped.

Places of the base phrases are counted from the same word list.

Defined cases: a null or empty text has no words, labels or places and score 0;
ids may be null or repeated (rows are told apart by a row number of the scan);
texts shorter than a gram give no hits; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quantspark.llm.common import read, stage

GRAM, SLACK, COVER, STRETCH, WEAK = 3, 3, 0.7, 1.6, 4
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Base phrases and the notices of public licenses.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
_WARRANTY = ("the software is provided as is without warranty of any kind express or implied including but not limited to the warranties "
             "of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders "
             "be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of "
             "or in connection with the software or the use or other dealings in the software")
_BSD = ("redistribution and use in source and binary forms with or without modification are permitted provided that the following "
        "conditions are met {0} redistributions of source code must retain the above copyright notice this list of conditions and the "
        "following disclaimer {1} redistributions in binary form must reproduce the above copyright notice this list of conditions and "
        "the following disclaimer in the documentation and or other materials provided with the distribution")
_BSD_3 = "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"
_BSD_END = ("this software is provided by the copyright holders and contributors as is and any express or implied warranties including but "
            "not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall "
            "the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages "
            "including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption "
            "however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise "
            "arising in any way out of the use of this software even if advised of the possibility of such damage")
_ISC = "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"
_MIT = "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"
_APACHE = "you may not use this file except in compliance with the license you may obtain a copy of the license at"
_MPL = "this source code form is subject to the terms of the mozilla public license v 2 0"
_UNLICENSE = "this is free and unencumbered software released into the public domain"
# A label's notices: what follows a slash only tells them apart.
TEMPLATES = {
    "agpl-3.0": "licensed under the gnu affero general public license version 3",
    "apache-2.0": "licensed under the apache license version 2 0",
    "apache-2.0/name": "apache license version 2 0",
    "apache-2.0/notice": f"licensed under the apache license version 2 0 the license {_APACHE} http www apache org licenses license 2 0 unless "
                         "required by applicable law or agreed to in writing software distributed under the license is distributed on an as is "
                         "basis without warranties or conditions of any kind either express or implied see the license for the specific "
                         "language governing permissions and limitations under the license",
    "apache-2.0-header": _APACHE,
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that "
           "the following conditions are met",
    "bsd-2-clause": f"{_BSD.format(1, 2)} {_BSD_END}",
    "bsd-3-clause": f"{_BSD.format(1, 2)} 3 {_BSD_3} {_BSD_END}",
    "cc-by-4.0": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-nc-4.0": "licensed under cc by nc 4 0",
    "cc-by-sa-4.0": "licensed under cc by sa 4 0",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "gpl-notice": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                  "general public license as published by the free software foundation",
    "isc": _ISC,
    "isc/notice": f"{_ISC} provided that the above copyright notice and this permission notice appear in all copies the software is provided "
                  "as is and the author disclaims all warranties with regard to this software including all implied warranties of "
                  "merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential "
                  "damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence "
                  "or other tortious action arising out of or in connection with the use or performance of this software",
    "lgpl": "licensed under the gnu lesser general public license",
    "mit-notice": "released under the mit license",
    "mit-text": _MIT,
    "mit-text/notice": f"{_MIT} the software to deal in the software without restriction including without limitation the rights to use copy "
                       "modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the "
                       "software is furnished to do so subject to the following conditions the above copyright notice and this permission "
                       f"notice shall be included in all copies or substantial portions of the software {_WARRANTY}",
    "mpl-2.0": _MPL,
    "mpl-2.0/notice": f"{_MPL} if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    "unlicense": _UNLICENSE,
    "unlicense/notice": f"{_UNLICENSE} anyone is free to copy modify publish use compile sell or distribute this software either in source code "
                        "form or as a compiled binary for any purpose commercial or non commercial and by any means in jurisdictions that "
                        "recognize copyright laws the author or authors of this software dedicate any and all copyright interest in the "
                        "software to the public domain we make this dedication for the benefit of the public at large and to the detriment "
                        "of our heirs and successors we intend this dedication to be an overt act of relinquishment in perpetuity of all "
                        f"present and future rights to this software under copyright law {_WARRANTY.replace('authors or copyright holders', 'authors')}",
}
# What tells a notice from its relatives: each phrase must stand in the text word by word.
KEYS = {
    "agpl-3.0": ("gnu affero general public license version 3",), "apache-2.0": ("apache license version 2 0",),
    "apache-2.0/name": ("apache license version 2 0",),
    "apache-2.0/notice": ("apache license version 2 0",), "bsd-3-clause": ("neither the name of",),
    "cc-by-4.0": ("creative commons attribution 4 0",), "cc-by-nc-4.0": ("cc by nc 4 0",), "cc-by-sa-4.0": ("cc by sa 4 0",),
    "gpl-3.0": ("gnu general public license version 3",), "gpl-notice": ("the gnu general public license",),
    "lgpl": ("gnu lesser general public license",), "mit-notice": ("the mit license",),
    "mpl-2.0": ("mozilla public license v 2 0",), "mpl-2.0/notice": ("mozilla public license v 2 0",),
}


def _family(label: str, notices: dict) -> None:
    for i, (text, keys) in enumerate(notices.items()):
        TEMPLATES[f"{label}/{i}"], KEYS[f"{label}/{i}"] = text, keys or (text,)


def _gnu(label: str, kind: str, version: str) -> None:
    license, short = f"gnu {kind} public license", label.split("-")[0]
    sentence = (f"this program is free software you can redistribute it and or modify it under the terms of the {license} as published by "
                f"the free software foundation either version {version} of the license or at your option any later version")
    keys = (f"the {license}", f"version {version} of the license")
    names = [f"{license} version {version}", f"{license} v{version}", f"{license} v {version}", f"gnu {short} version {version}"]
    bare = [*names, f"version {version} of the {license}", f"{short} {version if ' ' in version else version + ' 0'} or later",
            f"{short} {version if ' ' in version else version + ' 0'} only"]
    _family(label, {n: () for n in bare} | {f"licensed under the {n}": (n,) for n in names} | {
        sentence: keys,
        f"{sentence} this program is distributed in the hope that it will be useful but without any warranty without even the implied "
        f"warranty of merchantability or fitness for a particular purpose see the {license} for more details you should have received a copy "
        f"of the {license} along with this program if not see http www gnu org licenses": keys})


def _creative_commons(version: str) -> None:
    spelled = {"nc": ("noncommercial", "non commercial"), "sa": ("sharealike", "share alike"), "nd": ("noderivatives", "noderivs", "no derivatives")}
    for parts in ((), ("nc",), ("sa",), ("nd",), ("nc", "sa"), ("nc", "nd")):
        names = [" ".join(["creative commons attribution", *x, version]) for x in product(*[spelled[p] for p in parts])]
        _family("-".join(["cc-by", *parts, version.replace(" ", ".")]), {n: () for n in [" ".join(["cc by", *parts, version]), *names]})


for _row in (("agpl-3.0", "affero general", "3"), ("gpl-1.0", "general", "1"), ("gpl-2.0", "general", "2"), ("gpl-3.0", "general", "3"),
             ("lgpl-2.0", "library general", "2"), ("lgpl-2.1", "lesser general", "2 1"), ("lgpl-3.0", "lesser general", "3")):
    _gnu(*_row)
for _version in ("1 0", "2 0", "2 5", "3 0", "4 0"):
    _creative_commons(_version)


def _short(label: str, *texts: str) -> None:
    for i, text in enumerate((*texts, f"spdx license identifier {label.replace('.', ' ').replace('-', ' ')}")):
        TEMPLATES[f"{label}/short{i}"], KEYS[f"{label}/short{i}"] = text, (text,)


_short("apache-2.0", "apache license 2 0", "apache 2 0 license", "under apache 2 0", "under the apache 2 0")
_short("mit")
_short("bsd-2-clause", "bsd 2 clause license")
_short("bsd-3-clause", "bsd 3 clause license")
_short("mpl-2.0", "mozilla public license 2 0", "mozilla public license version 2 0")
for _label in ("gpl-2.0", "gpl-3.0", "agpl-3.0", "lgpl-2.1", "lgpl-3.0"):
    _name, _number = _label.split("-")
    _version = _number.removesuffix(".0").replace(".", " ")
    _short(_label, f"under the {_name}v{_version}", f"licensed under {_name}v{_version}", f"under {_name} {_number.replace('.', ' ')}",
           f"under the {_name} {_number.replace('.', ' ')}")


def words_of(text: Column) -> Column:
    # lower() also maps U+212A and U+0130 to letters a-z; they stay apart here
    plain = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("�")), F.lit("İ"), F.lit("�"))
    flat = F.btrim(F.regexp_replace(F.lower(plain), SEPARATORS, " "))
    return F.when(flat == "", F.array().cast("array<string>")).otherwise(F.split(flat, " "))


def _positions(words: Column) -> Column:
    """Sorted (start, label) of every place of every base phrase."""
    def places(phrase: str, label: str) -> Column:
        want = phrase.split()
        # only texts that hold all words of the phrase are walked through
        there = F.arrays_overlap(words, F.array(F.lit(want[0]))) & F.arrays_overlap(words, F.array(F.lit(want[-1])))
        last = F.size(words) - len(want)

        def here(i):
            ok = F.lit(True)
            for k, w in enumerate(want):
                ok = ok & (F.get(words, i + k) == w)
            return ok

        none = F.array().cast("array<struct<start:int,label:string>>")
        at = F.filter(F.sequence(F.lit(0), last), here)
        return F.when(there & (last >= 0), F.transform(at, lambda i: F.struct(i.alias("start"), F.lit(label).alias("label")))).otherwise(none)

    return F.array_sort(F.concat(*[places(p, x) for p, x in PHRASES.items()]))


def _template_grams(spark: SparkSession) -> DataFrame:
    """(hash, template, tpos) of every gram of every template."""
    rows = F.array(*[F.struct(F.lit(k).alias("template"), F.split(F.lit(v), " ").alias("w")) for k, v in TEMPLATES.items()])
    each = spark.range(1).select(F.inline(rows))
    return each.select("template", F.inline(_grams(F.col("w")))).select("hash", "template", F.col("pos").alias("tpos"))


def _grams(words: Column) -> Column:
    n = F.size(words) - GRAM
    at = F.when(n >= 0, F.sequence(F.lit(0), n)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.struct(i.alias("pos"), F.xxhash64(*[F.get(words, i + k) for k in range(GRAM)]).alias("hash")))


def hits(docs: DataFrame) -> DataFrame:
    """Staged: per document one row with template null, and one row per hit.
    (row, doc_id, n_words, places, template, tpos, pos)"""
    spark = docs.sparkSession
    listed = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", words_of(F.col("text")).alias("w"))
    marked = listed.select("row", "doc_id", F.size("w").alias("n_words"), _positions(F.col("w")).alias("places"), _grams(F.col("w")).alias("g"))
    own = F.array(F.struct(F.lit(-1).alias("pos"), F.lit(None).cast("long").alias("hash")))
    # places travel with the document's own row only
    each = (marked.select("row", "doc_id", "n_words", "places", F.inline(F.concat(own, "g")))
            .withColumn("places", F.when(F.col("pos") < 0, F.col("places"))))
    out = each.join(F.broadcast(_template_grams(spark)), "hash", "left").filter("pos < 0 OR template IS NOT NULL")
    return stage(out.select("row", "doc_id", "n_words", "places", "template", "tpos", "pos"), "license-hits")


def _template_facts(spark: SparkSession) -> DataFrame:
    """(template, size, keys): words of every template, and the positions of the grams of each of its key phrases."""
    rows = []
    for name, text in TEMPLATES.items():
        words = text.split()
        keys = []
        for key in (k.split() for k in KEYS.get(name, ())):
            at = next(i for i in range(len(words)) if words[i:i + len(key)] == key)
            keys.append(list(range(at, at + len(key) - GRAM + 1)))
        rows.append((name, len(words), keys))
    return spark.createDataFrame(rows, "template string, size int, keys array<array<int>>")


def spans(found: DataFrame) -> DataFrame:
    """Verified (row, template, first, end, votes, cover), from staged hits."""
    facts = F.broadcast(_template_facts(found.sparkSession))
    held = F.filter(F.sequence(F.lit(0), F.size("keys")), lambda k: F.size(F.array_except(F.get("keys", k), "tpos")) == 0)
    votes = (found.filter("template IS NOT NULL").withColumn("diagonal", F.col("pos") - F.col("tpos"))
             .groupBy("row", "template", "diagonal")
             .agg(F.count(F.lit(1)).alias("votes"), F.min("pos").alias("first"), F.max("pos").alias("last"),
                  F.collect_set("tpos").alias("tpos"))  # at most as many as the template has grams
             .join(facts, "template").withColumn("held", held))
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > SLACK, F.lit(True)).cast("int")

    def all_of(places: Column) -> Column:
        return F.array_distinct(F.flatten(F.collect_list(places)))

    def words(grams: Column | str) -> Column:
        return F.size(F.array_distinct(F.flatten(F.transform(grams, lambda p: F.sequence(p, p + (GRAM - 1))))))

    def too_long(*keys: str) -> Column:
        w = Window.partitionBy("row", "template", *keys)
        return F.max("last").over(w) + GRAM - F.min("first").over(w) > F.ceil(F.col("size") * STRETCH)

    runs = votes.withColumn("new", apart).withColumn("run", F.sum("new").over(order)).withColumn("long", too_long("run"))
    top = F.max("votes").over(Window.partitionBy("row", "template", "run"))
    runs = runs.withColumn("weak", F.col("long") & (F.col("votes") * WEAK < top))
    within = Window.partitionBy("row", "template", "run", "weak").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(within) > SLACK, F.lit(True)).cast("int")
    parts = runs.withColumn("new", apart).withColumn("part", F.sum("new").over(within))
    parts = parts.withColumn("alone", F.when(too_long("run", "weak", "part"), F.col("diagonal")))
    merged = (parts.groupBy("row", "template", "run", "weak", "part", "alone", "size", F.size("keys").alias("n_keys"))
              .agg(F.sum("votes").alias("votes"), F.min("first").alias("first"), (F.max("last") + GRAM).alias("end"),
                   all_of("tpos").alias("tpos"), all_of("held").alias("held"),
                   all_of(F.transform("tpos", lambda p: p + F.col("diagonal"))).alias("pos")))
    covered, length = words("tpos"), F.col("end") - F.col("first")
    # what stands between the hits was put in
    good = (merged.withColumn("covered", covered).withColumn("cover", F.col("covered") / (F.col("size") + length - words("pos")))
            .filter((F.size("held") == F.col("n_keys")) & (F.col("cover") >= COVER) & (length <= F.ceil(F.col("size") * STRETCH))))
    order = Window.partitionBy("row").orderBy("first", "end", "template")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    span = F.struct((-F.col("covered")).alias("rank"), (-F.col("cover")).alias("minus"), "template", "first", "end", "votes", "cover")
    none = F.array().cast("array<struct<rank:int,minus:double,template:string,first:int,end:int,votes:bigint,cover:double>>")
    # best first, a span stays unless it overlaps one that has stayed
    kept = F.aggregate("all", none, lambda have, x: F.when(
        F.exists(have, lambda y: (y["first"] < x["end"]) & (x["first"] < y["end"])), have).otherwise(F.concat(have, F.array(x))))
    return (good.withColumn("new", F.coalesce(F.col("first") >= reach, F.lit(True)).cast("int"))
            .withColumn("island", F.sum("new").over(order))
            .groupBy("row", "island").agg(F.array_sort(F.collect_list(span)).alias("all"))
            .select("row", F.inline(kept)).drop("rank", "minus")
            .withColumn("template", F.substring_index("template", "/", 1)))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, places, templates, cover): one row per row of ``docs``."""
    found = hits(docs)
    best = (spans(found).groupBy("row", "template").agg(F.max("cover").alias("cover"))
            .groupBy("row").agg(F.collect_set("template").alias("templates"), F.max("cover").alias("cover")))
    none = F.array().cast("array<string>")
    return (found.filter("pos < 0").select("row", "doc_id", "n_words", "places").join(best, "row", "left")
            .select("doc_id", "n_words", "places", F.coalesce("templates", none).alias("templates"), F.coalesce("cover", F.lit(0.0)).alias("cover")))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan(read(spark, sf_dir, "documents").select("doc_id", "text"))
    labels = F.array_distinct(F.transform("places", lambda p: p["label"]))
    starts = F.transform("places", lambda p: p["start"].cast("long"))
    return out.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(labels, "templates")), ",").alias("labels"),
        F.greatest(F.col("cover"), F.when(F.size("places") > 0, 0.5).otherwise(0.0)).alias("score"))
