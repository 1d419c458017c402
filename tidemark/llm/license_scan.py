"""Licence recognition by sentence rules, in DataFrame functions.

Known licence sentences are found in a text's normalised words and mapped to identifiers; the sequence of identifiers is then
matched against rules, each an ordered sequence of identifiers. Sentences that aren't known may stand between.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_of

#: Sentences of licence texts and notices, as they are written; the place in the list is the identifier.
SENTENCES = (
    "Released under the MIT License.",
    "Licensed under the MIT License.",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "Licensed under the Apache License, Version 2.0.",
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "You may obtain a copy of the License at",
    "This work is licensed under the GNU General Public License, version 3.",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "Licensed under CC BY 4.0.",
    "Licensed under CC BY-SA 4.0.",
    "Licensed under CC BY-NC 4.0.",
    "This work is dedicated to the public domain.",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "All rights reserved.",
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "Apache License Version 2.0, January 2004",
    "TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",
    "If a copy of the MPL was not distributed with this file, You can obtain one at",
    "Mozilla Public License Version 2.0",
    "means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software.",
    "This is free and unencumbered software released into the public domain.",
    "CC0 1.0 Universal",
    "Boost Software License - Version 1.0 - August 17th, 2003",
    "This software is provided 'as-is', without any express or implied warranty.",
    "In no event will the authors be held liable for any damages arising from the use of this software.",
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
)

#: Marks of the Creative Commons 4.0 licences and their names in notices; a notice and a title are known sentences of each.
COMMONS = {
    "BY": "Attribution",
    "BY-SA": "Attribution-ShareAlike",
    "BY-NC": "Attribution-NonCommercial",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}

#: Identifiers that a line "SPDX-License-Identifier: ..." may state.
SPDX = ("MIT", "MIT-0", "ISC", "0BSD", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "MPL-2.0", "EPL-2.0", "BSL-1.0", "Zlib", "Unlicense", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0")

_COMMONS_FROM = len(SENTENCES)
_SPDX_FROM = _COMMONS_FROM + 2 * len(COMMONS)
SENTENCES += tuple(t for name in COMMONS.values() for t in (f"This work is licensed under a Creative Commons {name} 4.0 International License.", f"Creative Commons {name} 4.0 International Public License"))
SENTENCES += tuple(f"SPDX-License-Identifier: {x}" for x in SPDX)


@dataclass(frozen=True)
class Rule:
    """A licence by an ordered sequence of identifiers, except where that is part of the sequence `unless`."""

    licence: str
    ids: tuple[int, ...]
    unless: tuple[int, ...] = ()


RULES = (
    Rule("MIT", (0,)),
    Rule("MIT", (1,)),
    Rule("MIT", (2, 3)),
    Rule("Apache-2.0", (4,)),
    Rule("Apache-2.0", (5, 6)),
    Rule("GPL-3.0", (7,)),
    Rule("GPL-3.0-or-later", (8, 9)),
    Rule("CC-BY-4.0", (10,)),
    Rule("CC-BY-SA-4.0", (11,)),
    Rule("CC-BY-NC-4.0", (12,)),
    Rule("public-domain", (13,)),
    Rule("BSD-2-Clause", (14, 15, 16), (14, 15, 16, 25)),
    Rule("BSD-3-Clause", (14, 15, 16, 25)),
    Rule("MPL-2.0", (17,)),
    Rule("all-rights-reserved", (18,)),
    Rule("MIT-0", (20, 19)),
    Rule("ISC", (21,)),
    Rule("ISC", (22,)),
    Rule("0BSD", (23,)),
    Rule("Apache-2.0", (27, 28)),
    Rule("GPL-2.0-or-later", (29, 9)),
    Rule("GPL-2.0-or-later", (29, 34)),
    Rule("GPL-3.0-or-later", (8, 34)),
    Rule("GPL-2.0-only", (30,)),
    Rule("LGPL-2.1-or-later", (31, 35)),
    Rule("LGPL-3.0-or-later", (32, 9)),
    Rule("AGPL-3.0-or-later", (33, 9)),
    Rule("GPL-2.0", (36, 41)),
    Rule("GPL-3.0", (37, 41)),
    Rule("LGPL-2.1", (38, 41)),
    Rule("LGPL-3.0", (39, 41)),
    Rule("AGPL-3.0", (40, 41)),
    Rule("MPL-2.0", (43, 44)),
    Rule("Unlicense", (45,)),
    Rule("CC0-1.0", (46,)),
    Rule("BSL-1.0", (47,)),
    Rule("Zlib", (48, 49)),
    Rule("EPL-2.0", (50,)),
    *(Rule(f"CC-{mark}-4.0", (_COMMONS_FROM + 2 * i + k,)) for i, mark in enumerate(COMMONS) for k in (0, 1)),
    *(Rule(x, (_SPDX_FROM + i,)) for i, x in enumerate(SPDX)),
)


def normalise(sentence: str) -> str:
    import re

    return re.sub(r"[^a-z0-9]+", " ", sentence.translate({c: c + 32 for c in range(65, 91)})).strip(" ")


def lower_ascii(c: Column) -> Column:
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(c, letters, letters.lower())


def marked(text: Column) -> Column:
    """The normalised words of a text: one space within a line, a line break between lines, E between sentences.

    A sentence ends at white space after one of . ! ? :, and a line break may stand in a sentence that is wrapped. E is no
    word's letter, since letters are lower case by then. Marks stand at both ends, and an empty line leaves two line breaks.
    """
    ended = F.regexp_replace(lower_ascii(text), r"[.!?:][\x20\x09-\x0D]+", "E")
    words = F.regexp_replace(F.regexp_replace(ended, "[^a-z0-9E\n]+", " "), " ?([E\n]) ?", "$1")
    return F.concat(F.lit("\n"), F.trim(words), F.lit("\n"))


def pattern_of(sentence: str) -> str:
    """Matches the sentence in a marked text: its words, with a line break wherever it's wrapped, and E where it holds one."""
    import re

    parts = (normalise(p) for p in re.split(r"[.!?:][\x20\x09-\x0D]+", sentence))
    return "[ \nE]".join(p.replace(" ", "[ \n]") for p in parts if p)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: tuple[str, ...] = SENTENCES, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per input row: the id, sentence_ids (array of known identifiers in order), licences (sorted, comma-joined), n_rules.

    A known sentence is found where it starts and ends at a sentence's or a line's end, on one line or wrapped over several
    without an empty one; of those that start together the longest counts. A rule matches where its identifiers follow one
    another among the text's known ones. A null or empty text matches nothing; repeated rows give repeated rows; an empty
    table gives no rows. Known sentences of one normal form are one.
    """
    table: dict[str, int] = {}
    for i, s in enumerate(known):
        table.setdefault(normalise(s), i)
    same = [table[normalise(s)] for s in known]
    lookup = F.create_map(*(F.lit(x) for kv in table.items() for x in kv))
    patterns = sorted({pattern_of(s) for s in known if normalise(s)}, key=len, reverse=True)
    found = F.regexp_extract_all(marked(text_of(text_col)), F.lit(f"(?<=[E\n])(?:{'|'.join(patterns) or '(?!)'})(?=[E\n])"), F.lit(0))
    rows = docs.select(F.col(id_col), F.transform(found, lambda s: F.element_at(lookup, F.translate(s, "E\n", "  "))).alias("sentence_ids"))
    told = rows.withColumn("told", F.concat(F.lit(","), F.array_join("sentence_ids", ","), F.lit(",")))
    sequence = lambda ids: "," + ",".join(str(same[i]) for i in ids) + ","
    left = lambda r: F.replace(F.col("told"), F.lit(sequence(r.unless)), F.lit(",")) if r.unless else F.col("told")
    hits = [(r.licence, left(r).contains(sequence(r.ids))) for r in rules]
    matched = F.filter(F.array(*(F.when(h, F.lit(name)) for name, h in hits)), lambda x: x.isNotNull())
    return told.select(id_col, "sentence_ids", F.array_join(F.array_sort(F.array_distinct(matched)), ",").alias("licences"), F.size(matched).cast("long").alias("n_rules"))


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return scan(docs, id_col, text_col).select(id_col, F.array_join("sentence_ids", ",").alias("sentence_ids"), "licences", "n_rules")
