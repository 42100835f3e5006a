"""Licence recognition by sentences: known sentences become identifiers, ordered rules match their sequence.

Everything is a column expression on one row: no shuffle, no Python in the tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .support import filled, picked

# Sentences that licences and licence notices consist of, normalised (lower case,
# other characters than letters and digits as one space), by identifier.
SENTENCES = {
    "S001": ("licensed under the apache license version 2 0",),
    "S002": ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",),
    "S003": ("you may obtain a copy of the license at http www apache org licenses license 2 0",
             "you may obtain a copy of the license at https www apache org licenses license 2 0"),
    "S004": ("unless required by applicable law or agreed to in writing software distributed under the license is distributed on an "
             "as is basis without warranties or conditions of any kind either express or implied",),
    "S005": ("see the license for the specific language governing permissions and limitations under the license",),
    "S010": ("released under the mit license", "licensed under the mit license", "this project is licensed under the mit license"),
    "S011": ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation "
             "files the software to deal in the software without restriction including without limitation the rights to use copy modify "
             "merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is "
             "furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be "
             "included in all copies or substantial portions of the software",),
    "S012": ("the software is provided as is without warranty of any kind express or implied including but not limited to the warranties "
             "of merchantability fitness for a particular purpose and noninfringement",),
    "S020": ("this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 3"),
    "S021": ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
             "published by the free software foundation either version 3 of the license or at your option any later version",),
    "S022": ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
             "published by the free software foundation either version 2 of the license or at your option any later version",),
    "S023": ("this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of "
             "merchantability or fitness for a particular purpose",),
    "S024": ("see the gnu general public license for more details",),
    "S030": ("licensed under cc by nc 4 0", "this work is licensed under cc by nc 4 0"),
    "S031": ("licensed under cc by 4 0", "this work is licensed under cc by 4 0",
             "this work is licensed under a creative commons attribution 4 0 international license"),
    "S032": ("licensed under cc by sa 4 0", "this work is licensed under cc by sa 4 0"),
    "S040": ("redistribution and use in source and binary forms with or without modification are permitted provided that the following "
             "conditions are met 1",
             "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
             "conditions are met"),
    "S043": ("redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",),
    "S041": ("redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer "
             "in the documentation and or other materials provided with the distribution",),
    "S042": ("neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
             "from this software without specific prior written permission",),
    "S050": ("this source code form is subject to the terms of the mozilla public license v",),
    "S060": ("all rights reserved",),
    "S070": ("this is free and unencumbered software released into the public domain",),
}

# Which sentences, in this order and with none of the others between them, make a licence.
RULES = (
    ("Apache-2.0", ("S002", "S003", "S004", "S005")),
    ("Apache-2.0", ("S002",)),
    ("Apache-2.0", ("S001",)),
    ("MIT", ("S011", "S012")),
    ("MIT", ("S010", "S011", "S012")),
    ("MIT", ("S010",)),
    ("GPL-3.0-or-later", ("S021", "S023", "S024")),
    ("GPL-3.0-or-later", ("S021",)),
    ("GPL-2.0-or-later", ("S022", "S023", "S024")),
    ("GPL-2.0-or-later", ("S022",)),
    ("GPL-3.0-only", ("S020",)),
    ("CC-BY-NC-4.0", ("S030",)),
    ("CC-BY-4.0", ("S031",)),
    ("CC-BY-SA-4.0", ("S032",)),
    ("BSD-3-Clause", ("S040", "S043", "S041", "S042")),
    ("BSD-2-Clause", ("S040", "S043", "S041")),
    ("MPL-2.0", ("S050",)),
    ("Unlicense", ("S070",)),
    ("proprietary", ("S060",)),
)

#: A sentence ends at these marks before white space.
SENTENCE_END = r"[.!?]+[\x20\x09-\x0D]+"


def known_sentences() -> dict[str, str]:
    return {text: ident for ident, texts in SENTENCES.items() for text in texts}


def rule_pattern() -> str:
    """All rules as one expression over joined identifiers (all equally long), longer rules first."""
    ordered = sorted({"".join(ids) for _, ids in RULES}, key=lambda ids: (-len(ids), ids))
    return "|".join(ordered)


def rule_names() -> dict[str, str]:
    return {"".join(ids): name for name, ids in RULES}


def _lookup(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])


def normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """The licences that each whole text names.

    docs: doc_id and text, other columns are ignored. A sentence is known by its normalised text or,
    if that fails, by that of its last line (what stands above may be a heading without a full
    stop). Known sentences become identifiers; a rule matches where its identifiers follow each
    other with no other known sentence between, leftmost and longest first. A null or empty text
    has no licence. Repeated rows and rows without doc_id come out as they came in. An empty table
    gives an empty result. Returns doc_id, n_sentences (known ones), sentence_ids (joined by
    spaces), licenses (of the matched rules, in order of first appearance, comma-joined).
    """
    known = _lookup(known_sentences())
    sentences = F.split(F.concat(filled(), F.lit(" ")), SENTENCE_END, -1)
    ids = F.filter(F.transform(sentences, lambda s: F.coalesce(
        F.try_element_at(known, normalised(s)),
        F.try_element_at(known, normalised(F.substring_index(s, "\n", -1))))), lambda x: x.isNotNull())
    found = picked(docs).select("doc_id", ids.alias("ids"))
    rules = F.regexp_extract_all(F.array_join("ids", ""), F.lit(rule_pattern()), 0)
    names = _lookup(rule_names())
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_sentences"), F.array_join("ids", " ").alias("sentence_ids"),
        F.array_join(F.array_distinct(F.transform(rules, lambda r: F.try_element_at(names, r))), ",").alias("licenses"))
