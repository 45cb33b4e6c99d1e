"""Licence scans by sentence rules.

All texts are cut into sentences, both line by line and with wrapped lines joined. Normalised sentences are
looked up among known ones by an equality join with a fixed small table. The identifiers of a document, in order, are then matched against
licence rules, the most specific ones first; what a rule has matched no later rule sees.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Known sentences, normalised, by identifier. The wording of public licences.
SENTENCES = {
    "apache2-under": ["licensed under the apache license version 2 0", "licensed under the apache license version 2 0 the license", "this project is licensed under the apache license version 2 0"],
    "apache2-comply": ["you may not use this file except in compliance with the license"],
    "apache2-copy": ["you may obtain a copy of the license at"],
    "apache2-url": ["http www apache org licenses license 2 0", "https www apache org licenses license 2 0"],
    "apache2-asis": ["unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"],
    "apache2-see": ["see the license for the specific language governing permissions and limitations under the license"],
    "mit-under": ["released under the mit license", "licensed under the mit license", "this project is licensed under the mit license", "distributed under the mit license", "the mit license mit", "mit license"],
    "mit-grant": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"],
    "mit-notice": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"],
    "mit-asis": ["the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"],
    "mit-liable": ["in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"],
    "bsd-forms": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "bsd-source": ["redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"],
    "bsd-binary": ["redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"],
    "bsd-advert": ["all advertising materials mentioning features or use of this software must display the following acknowledgement"],
    "bsd-endorse": ["neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"],
    "gpl2-under": ["this work is licensed under the gnu general public license version 2", "licensed under the gnu general public license version 2"],
    "gpl3-under": ["this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 3"],
    "free-software": ["this program is free software", "this library is free software"],
    "gpl-terms": ["you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"],
    "lgpl-terms": ["you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"],
    "agpl3-later-terms": ["you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "gpl3-later-terms": ["you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "lgpl3-later-terms": ["you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "version-2": ["version 2 of the license"],
    "version-2-later": ["either version 2 of the license or at your option any later version"],
    "version-2-1-later": ["either version 2 1 of the license or at your option any later version"],
    "version-3-later": ["either version 3 of the license or at your option any later version"],
    "mpl2-subject": ["this source code form is subject to the terms of the mozilla public license v", "this source code form is subject to the terms of the mozilla public license v 2 0"],
    "isc-grant": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"],
    "boost-under": ["distributed under the boost software license version 1 0"],
    "unlicense-free": ["this is free and unencumbered software released into the public domain"],
    "zlib-asis": ["this software is provided as is without any express or implied warranty"],
    "zlib-grant": ["permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions"],
    "cc-by": ["licensed under cc by 4 0", "this work is licensed under a creative commons attribution 4 0 international license"],
    "cc-by-sa": ["licensed under cc by sa 4 0", "this work is licensed under a creative commons attribution sharealike 4 0 international license"],
    "cc-by-nc": ["licensed under cc by nc 4 0", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"],
    "cc-by-nd": ["licensed under cc by nd 4 0", "this work is licensed under a creative commons attribution noderivatives 4 0 international license"],
    "cc0": ["licensed under cc0 1 0", "cc0 1 0 universal"],
    "spdx": ["spdx license identifier"],
    "name-mit": ["mit"], "name-apache2": ["apache 2 0"], "name-bsd2": ["bsd 2 clause"], "name-bsd3": ["bsd 3 clause"], "name-isc": ["isc"],
    "name-gpl2": ["gpl 2 0 only"], "name-gpl3": ["gpl 3 0 only"], "name-gpl3-later": ["gpl 3 0 or later"], "name-mpl2": ["mpl 2 0"],
    "all-rights": ["all rights reserved"],
}
#: Rules: a licence, and the identifiers that name it when they follow each other. Fixed values, in the order they are tried.
RULES = [
    ("Apache-2.0", ["apache2-under", "apache2-comply", "apache2-copy", "apache2-url", "apache2-asis", "apache2-see"]),
    ("Apache-2.0", ["apache2-under", "apache2-comply", "apache2-copy"]),
    ("MIT", ["mit-under", "mit-grant", "mit-notice", "mit-asis", "mit-liable"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-asis", "mit-liable"]),
    ("BSD-4-Clause", ["bsd-forms", "bsd-source", "bsd-binary", "bsd-advert", "bsd-endorse"]),
    ("BSD-3-Clause", ["bsd-forms", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-2-Clause", ["bsd-forms", "bsd-source", "bsd-binary"]),
    ("AGPL-3.0-or-later", ["free-software", "agpl3-later-terms"]),
    ("GPL-3.0-or-later", ["free-software", "gpl3-later-terms"]),
    ("LGPL-3.0-or-later", ["free-software", "lgpl3-later-terms"]),
    ("GPL-2.0-or-later", ["free-software", "gpl-terms", "version-2-later"]),
    ("GPL-3.0-or-later", ["free-software", "gpl-terms", "version-3-later"]),
    ("GPL-2.0-only", ["free-software", "gpl-terms", "version-2"]),
    ("LGPL-2.1-or-later", ["free-software", "lgpl-terms", "version-2-1-later"]),
    ("Zlib", ["zlib-asis", "zlib-grant"]),
    ("MIT", ["spdx", "name-mit"]), ("Apache-2.0", ["spdx", "name-apache2"]), ("BSD-2-Clause", ["spdx", "name-bsd2"]), ("BSD-3-Clause", ["spdx", "name-bsd3"]),
    ("ISC", ["spdx", "name-isc"]), ("GPL-2.0-only", ["spdx", "name-gpl2"]), ("GPL-3.0-only", ["spdx", "name-gpl3"]), ("GPL-3.0-or-later", ["spdx", "name-gpl3-later"]), ("MPL-2.0", ["spdx", "name-mpl2"]),
    ("Apache-2.0", ["apache2-under"]), ("MIT", ["mit-under"]), ("GPL-2.0-only", ["gpl2-under"]), ("GPL-3.0-only", ["gpl3-under"]), ("MPL-2.0", ["mpl2-subject"]), ("ISC", ["isc-grant"]),
    ("BSL-1.0", ["boost-under"]), ("Unlicense", ["unlicense-free"]), ("CC-BY-4.0", ["cc-by"]), ("CC-BY-SA-4.0", ["cc-by-sa"]), ("CC-BY-NC-4.0", ["cc-by-nc"]), ("CC-BY-ND-4.0", ["cc-by-nd"]), ("CC0-1.0", ["cc0"]),
]
#: A text that holds one of these speaks of licences; in others a bare name, like a line "mit", is no mention of one.
CUES = "licen[sc]e|redistribut|hereby granted|permission is granted|public domain|rights reserved|licensed under cc"
_COMMENT = r"(^|\n)[ \t]*(//+|/?[*]+/?|#+|;+|--+|%+|<!--)[ \t]*"
_WRAP = r"([^.!?;:\s])[ \t\r]*\n[ \t]*(\S)"
_ENDS = r"[.!?;:]+(\s+|$)|\s*\n\s*"
A_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def normalised(sentence: Column) -> Column:
    """ASCII letters in lower case and digits, one space between words; licence spelt with an s."""
    plain = F.trim(F.regexp_replace(F.translate(sentence, A_Z, A_Z.lower()), "[^a-z0-9]+", " "))
    return F.replace(plain, F.lit("licence"), F.lit("license"))


def sentences(text: Column, joined: bool) -> Column:
    """The sentences of a text without comment signs; ``joined``: lines that end within a sentence go on in the next."""
    bare = F.regexp_replace(text, _COMMENT, "$1")
    if joined:
        bare = F.regexp_replace(bare, _WRAP, "$1 $2")
    return F.split(bare, _ENDS)


def known_sentences(docs: DataFrame) -> DataFrame:
    """``doc_id, row, joined, place, sentence, cued``: identifiers of the known sentences of each row, in both ways of cutting, and whether its text holds a cue."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")).withColumns({"row": F.monotonically_increasing_id(), "cued": F.lower("text").rlike(CUES)})
    known = docs.sparkSession.createDataFrame([(s, i) for i, all_of in SENTENCES.items() for s in all_of], "known string, sentence string")
    ways = F.array(*(F.struct(F.lit(joined).alias("joined"), sentences(F.col("text"), joined).alias("parts")) for joined in (False, True)))
    cut = rows.select("doc_id", "row", "cued", F.inline(ways)).select("doc_id", "row", "cued", "joined", F.posexplode("parts").alias("place", "s"))
    # The table of known sentences is fixed, so it may be broadcast.
    return cut.withColumn("s", normalised(F.col("s"))).join(F.broadcast(known), F.col("s") == F.col("known")).select("doc_id", "row", "joined", "place", "sentence", "cued")


def licences(docs: DataFrame) -> DataFrame:
    """``doc_id, licences, n_sentences, n_unmatched``: one row for each row of ``docs`` that has a known sentence.

    ``licences`` lists the licences that rules found, in alphabetic order and joined by commas, empty if none did. ``n_sentences`` counts known
    sentences and ``n_unmatched`` those that no rule took, each in the way of cutting that leaves fewer unmatched (line by line, if equal).
    Null and empty texts have none, and bare names (``name-``) alone count only in a text that holds a cue; repeated rows are scanned as
    often as they occur. Other columns are not read.
    """
    wrapped = lambda i: F.concat(F.lit("<"), i, F.lit(">"))
    says = F.max(F.col("cued") | ~F.startswith(F.col("sentence"), F.lit("name-"))).alias("says")
    ordered = known_sentences(docs).groupBy("row", "joined").agg(F.first("doc_id").alias("doc_id"), says, F.sort_array(F.collect_list(F.struct("place", "sentence"))).alias("found"))
    marks = ordered.select("doc_id", "row", "joined", "says", F.size("found").cast("long").alias("n"), F.concat_ws("", F.transform("found", lambda f: wrapped(f["sentence"]))).alias("marks"))
    rules = F.array(*(F.struct(F.lit(name).alias("name"), F.lit("".join(f"<{i}>" for i in ids)).alias("ids")) for name, ids in RULES))
    start = F.struct(F.col("marks").alias("rest"), F.array().cast("array<string>").alias("names"))
    step = lambda a, r: F.when(F.contains(a["rest"], r["ids"]), F.struct(F.replace(a["rest"], r["ids"], F.lit("|")).alias("rest"), F.array_union(a["names"], F.array(r["name"])).alias("names"))).otherwise(a)
    matched = marks.withColumn("m", F.aggregate(rules, start, step)).select("doc_id", "row", "joined", "says", "n", F.col("m.names").alias("names"), (F.length("m.rest") - F.length(F.replace("m.rest", F.lit("<"), F.lit("")))).cast("long").alias("open"))
    both = matched.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.max("says").alias("says"), F.array_distinct(F.flatten(F.collect_list("names"))).alias("names"), F.min(F.struct("open", "joined", "n")).alias("best"))
    return both.filter("says").select("doc_id", F.concat_ws(",", F.sort_array("names")).alias("licences"), F.col("best.n").alias("n_sentences"), F.col("best.open").alias("n_unmatched"))


def licences_sql() -> str:
    """The same over a table ``documents`` as SQL for DuckDB: one step for each rule."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({quoted(s)}, {quoted(i)})" for i, all_of in SENTENCES.items() for s in all_of)
    ends = _ENDS.replace("$", r"\z")
    bare = f"regexp_replace(text, {quoted(_COMMENT)}, '\\1', 'g')"
    plain = f"replace(trim(regexp_replace(translate(s, '{A_Z}', '{A_Z.lower()}'), '[^a-z0-9]+', ' ', 'g')), 'licence', 'license')"
    steps, before = [], "m0"
    for k, (name, ids) in enumerate(RULES, 1):
        mark = quoted("".join(f"<{i}>" for i in ids))
        steps.append(f"m{k} AS (SELECT row, doc_id, joined, n, CASE WHEN contains(rest, {mark}) THEN list_append(names, {quoted(name)}) ELSE names END AS names, replace(rest, {mark}, '|') AS rest FROM {before})")
        before = f"m{k}"
    return f"""
WITH known(s, sentence) AS (VALUES {known}),
d AS (SELECT row_number() OVER () AS row, doc_id, text FROM documents WHERE text IS NOT NULL AND regexp_matches(lower(text), {quoted(CUES)})),
cut AS (SELECT row, doc_id, false AS joined, string_split_regex({bare}, {quoted(ends)}) AS parts FROM d
  UNION ALL SELECT row, doc_id, true, string_split_regex(regexp_replace({bare}, {quoted(_WRAP)}, '\\1 \\2', 'g'), {quoted(ends)}) FROM d),
part AS (SELECT row, doc_id, joined, unnest(parts) AS s, unnest(range(len(parts))) AS place FROM cut),
hit AS (SELECT row, doc_id, joined, place, sentence FROM (SELECT row, doc_id, joined, place, {plain} AS s FROM part) JOIN known USING (s)),
m0 AS (SELECT row, any_value(doc_id) AS doc_id, joined, count(*) AS n, []::VARCHAR[] AS names, string_agg('<' || sentence || '>', '' ORDER BY place) AS rest FROM hit GROUP BY row, joined),
{", ".join(steps)},
e AS (SELECT *, length(rest) - length(replace(rest, '<', '')) AS open FROM {before})
SELECT any_value(doc_id) AS doc_id, array_to_string(list_sort(list_distinct(flatten(list(names)))), ',') AS licences,
  arg_min(n, open * 2 + joined::INTEGER) AS n_sentences, min(open) AS n_unmatched
FROM e GROUP BY row
"""
