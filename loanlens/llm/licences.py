"""Licence scans by sentence rules, in DataFrame functions only.

A text is cut into sentences, each is normalised and looked up among known licence
sentences, and the sequence of their identifiers is matched against ordered rules, the
longest rule first; a matched run is used up, so a rule inside a longer one is not
reported beside it.  Comment leaders go before the cuts, so an empty comment line ends a
sentence, and the parts of template sentences that vary are set to a fixed wording.  A
sentence that runs over several lines is tried as a whole, else each run of whole lines in
it (a title or copyright line without a full stop stays with the grant behind it).
A line ``SPDX-License-Identifier:`` gives an identifier ``spdx:X`` for each name of its expression,
and X as licence.  Everything is an expression on the row: no shuffle, no join.

Defined results: null and empty texts, and texts without known sentences, have no
identifiers and no licences; a licence matched twice is named once; other columns pass
through; ValueError if they are called like an output column.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licences and notices, by identifier.
SENTENCES = {
    "mit-title": "The MIT License (MIT)",
    "mit-name": "MIT License",
    "mit-released": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                 "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
                 "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
                 "to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
                    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "mit-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN "
                     "AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
                     "OTHER DEALINGS IN THE SOFTWARE.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
                 "provided that the above copyright notice and this permission notice appear in all copies.",
    "apache-short": "Licensed under the Apache License, Version 2.0.",
    "apache-grant": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache-use": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-warranty": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
                       "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "apache-see": "See the License for the specific language governing permissions and limitations under the License.",
    "gpl3-work": "This work is licensed under the GNU General Public License, version 3.",
    "gpl3-later": "you can redistribute it and/or modify it under the terms of the GNU General Public "
                  "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl2-terms": "you can redistribute it and/or modify it under the terms of the GNU General Public "
                  "License as published by the Free Software Foundation;",
    "gpl2-later": "either version 2 of the License, or (at your option) any later version.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                 "following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
                  "disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
                 "derived from this software without specific prior written permission.",
    "cc0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "cc-by-nc-4": "Licensed under CC BY-NC 4.0.",
    "cc-by-4": "Licensed under CC BY 4.0.",
    "cc-by-sa-4": "Licensed under CC BY-SA 4.0.",
    "cc-by-long": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "mpl2": "This Source Code Form is subject to the terms of the Mozilla Public License, v.",
    "mpl2-text": "Mozilla Public License Version 2.0",
    "mit-project": "This project is licensed under the MIT License.",
    "apache-text": "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
    "apache-project": "This project is licensed under the Apache License, Version 2.0.",
    "apache-or-mit": "Licensed under either of Apache License, Version 2.0 or MIT license at your option.",
    "zero-bsd-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "bsd3-title": "BSD 3-Clause License",
    "bsd2-title": "BSD 2-Clause License",
    "gpl3-text": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "gpl2-text": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "gpl2-only": "you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the "
                 "Free Software Foundation.",
    "gpl2-only-comma": "you can redistribute it and/or modify it under the terms of the GNU General Public License, version 2, as published by the "
                       "Free Software Foundation.",
    "gpl2-version": "version 2 of the License.",
    "gpl2-or": "either version 2, or (at your option) any later version.",
    "gpl2-later-comma": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
                        "Free Software Foundation, either version 2 of the License, or (at your option) any later version.",
    "gpl3-either": "either version 3 of the License, or (at your option) any later version.",
    "lgpl21-text": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    "lgpl3-text": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "lgpl-terms": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the "
                  "Free Software Foundation;",
    "lgpl21-later": "either version 2.1 of the License, or (at your option) any later version.",
    "lgpl21-only": "version 2.1 of the License.",
    "lgpl3-later": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the "
                   "Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "agpl3-text": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    "agpl3-later": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the "
                   "Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "agpl-terms": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the "
                  "Free Software Foundation;",
    "epl2": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is "
            "available at https://www.eclipse.org/legal/epl-2.0/",
    "epl2-v": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0",
    "epl2-text": "Eclipse Public License - v 2.0",
    "epl1": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 "
            "which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "unlicense-copy": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a "
                      "compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "boost-title": "Boost Software License - Version 1.0 - August 17th, 2003",
    "boost-short": "Distributed under the Boost Software License, Version 1.0.",
    "boost-grant": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying "
                   "documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the "
                   "Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do "
                   "so, all subject to the following:",
    "zlib-as-is": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib-liable": "In no event will the authors be held liable for any damages arising from the use of this software.",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
                  "redistribute it freely, subject to the following restrictions:",
    "cc-by-4-work": "This work is licensed under CC BY 4.0",
    "cc-by-sa-4-work": "This work is licensed under CC BY-SA 4.0",
    "cc-by-nc-4-work": "This work is licensed under CC BY-NC 4.0",
    "cc-by-sa-long": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nc-long": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc-by-nd-long": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "cc-by-nc-sa-long": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "cc-by-nc-nd-long": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    "cc0-work": "This work is licensed under CC0 1.0 Universal",
    "wtfpl": "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE Version 2, December 2004",
}

# Licence and the sentences that show it, in this order and next to each other among known sentences.
RULES = [
    ("MIT", ["mit-grant", "mit-notice", "mit-warranty", "mit-liability"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("MIT", ["mit-title"]), ("MIT", ["mit-name"]), ("MIT", ["mit-released"]), ("MIT", ["mit-licensed"]),
    ("ISC", ["isc-grant"]),
    ("Apache-2.0", ["apache-grant", "apache-use", "apache-copy", "apache-warranty", "apache-see"]),
    ("Apache-2.0", ["apache-grant", "apache-use"]),
    ("Apache-2.0", ["apache-short"]),
    ("GPL-3.0-only", ["gpl3-work"]), ("GPL-3.0-or-later", ["gpl3-later"]), ("GPL-2.0-or-later", ["gpl2-terms", "gpl2-later"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("CC0-1.0", ["cc0"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4"]), ("CC-BY-4.0", ["cc-by-4"]), ("CC-BY-4.0", ["cc-by-long"]), ("CC-BY-SA-4.0", ["cc-by-sa-4"]),
    ("MPL-2.0", ["mpl2"]), ("MPL-2.0", ["mpl2-text"]),
    ("MIT", ["mit-project"]), ("Apache-2.0", ["apache-text"]), ("Apache-2.0", ["apache-project"]), ("Apache-2.0 OR MIT", ["apache-or-mit"]),
    ("0BSD", ["zero-bsd-grant"]), ("BSD-3-Clause", ["bsd3-title"]), ("BSD-2-Clause", ["bsd2-title"]),
    ("GPL-3.0-only", ["gpl3-text"]), ("GPL-2.0-only", ["gpl2-text"]), ("GPL-2.0-only", ["gpl2-only"]), ("GPL-2.0-only", ["gpl2-only-comma"]),
    ("GPL-2.0-only", ["gpl2-terms", "gpl2-version"]), ("GPL-2.0-or-later", ["gpl2-terms", "gpl2-or"]), ("GPL-2.0-or-later", ["gpl2-later-comma"]),
    ("GPL-3.0-or-later", ["gpl2-terms", "gpl3-either"]),
    ("LGPL-2.1-only", ["lgpl21-text"]), ("LGPL-3.0-only", ["lgpl3-text"]), ("LGPL-2.1-or-later", ["lgpl-terms", "lgpl21-later"]),
    ("LGPL-2.1-only", ["lgpl-terms", "lgpl21-only"]), ("LGPL-3.0-or-later", ["lgpl-terms", "gpl3-either"]), ("LGPL-2.0-or-later", ["lgpl-terms", "gpl2-later"]),
    ("LGPL-3.0-or-later", ["lgpl3-later"]),
    ("AGPL-3.0-only", ["agpl3-text"]), ("AGPL-3.0-or-later", ["agpl3-later"]), ("AGPL-3.0-or-later", ["agpl-terms", "gpl3-either"]),
    ("EPL-2.0", ["epl2"]), ("EPL-2.0", ["epl2-v"]), ("EPL-2.0", ["epl2-text"]), ("EPL-1.0", ["epl1"]),
    ("Unlicense", ["unlicense", "unlicense-copy"]), ("Unlicense", ["unlicense"]),
    ("BSL-1.0", ["boost-title", "boost-grant"]), ("BSL-1.0", ["boost-title"]), ("BSL-1.0", ["boost-short"]), ("BSL-1.0", ["boost-grant"]),
    ("Zlib", ["zlib-as-is", "zlib-liable", "zlib-grant"]), ("Zlib", ["zlib-grant"]),
    ("CC-BY-4.0", ["cc-by-4-work"]), ("CC-BY-SA-4.0", ["cc-by-sa-4-work"]), ("CC-BY-NC-4.0", ["cc-by-nc-4-work"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-long"]), ("CC-BY-NC-4.0", ["cc-by-nc-long"]), ("CC-BY-ND-4.0", ["cc-by-nd-long"]),
    ("CC-BY-NC-SA-4.0", ["cc-by-nc-sa-long"]), ("CC-BY-NC-ND-4.0", ["cc-by-nc-nd-long"]), ("CC0-1.0", ["cc0-work"]), ("WTFPL", ["wtfpl"]),
]

#: Every known sentence has one of these; other sentences need no look-up.
CUES = "licen|permi|copyright|warrant|redistribut|liab|public domain|free to copy|later version"
# Comment characters, and a list mark in brackets, at line starts.
LEADER = r"(^|\n)[ \t*/#;%!-]*+(?:\(?[0-9A-Za-z]\)[ \t]+)?"
# Parts of known sentences that vary (holder, joining words, address), and their wording above.
TEMPLATES = [
    (r"(?i)\bneither\s+the\s+name(?:s|\(s\))?\s+of\s+[^;:]+?\s+nor\s+the\s+names?\s+of\s+(?:[a-z]+\s+){0,2}contributors\b",
     "Neither the name of the copyright holder nor the names of its contributors"),
    (r"(?i)\bthe\s+names?\s+of\s+[^.:;]+?\s+may\s+not\s+be\s+used\s+to\s+endorse\b",
     "Neither the name of the copyright holder nor the names of its contributors may be used to endorse"),
    (r"(?i)\bin\s+no\s+event\s+shall\s+[^;:]+?\s+be\s+liable\s+for\s+any\s+claim\b",
     "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM"),
    (r"(?i)\bmodify,?\s+and\s+distribute\s+this\s+software\s+for\s+any\s+purpose\s+with\s+or\s+without\s+fee\s+is\s+hereby\s+granted\b",
     "modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    (r"(?i)\bto the extent possible under law,\s+[^;:.]+?\s+(?:has|have)\s+waived\s+all\s+copyright\s+and\s+related\s+or\s+neighbou?ring\s+rights\s+to\s+[^.;:\n]+",
     "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    (r"(?i)\bobtain\s+a\s+copy\s+of\s+the\s+license\s+at\s+https?://", "obtain a copy of the License at http://"),
]
# A line that names licences by identifier is a sentence of its own; its identifiers are known by their form.
SPDX, SPDX_MARK = r"(?i)SPDX-License-Identifier:[ \t]*([A-Za-z0-9.+() \t-]+)", "spdx licence identifier"
# Sentences end after these marks at white space, and at blank lines.
END, BLANK = r"([.!?:;])[ \t\n\r\f]+", r"\n[ \t\r]*\n"


def normal(text: str) -> str:
    """Lower-case ASCII letters and digits; anything else one space."""
    return re.sub(r"[^a-z0-9]+", " ", text.lower()).strip()


def _literal(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _known(sentences: dict[str, str]) -> dict[str, str]:
    """Identifier by normalised sentence."""
    out = {normal(s): name for name, s in sentences.items()}
    for key, name in out.items():
        if not re.search(CUES, key) or re.search(END, sentences[name]):
            raise ValueError(f"{name} has none of the cue words, or is more than one sentence")
    return out


def _runs(known: dict[str, str]) -> str:
    """Pattern of a known sentence, the longest first, that takes up whole lines of a lower-case text."""
    keys = "|".join("[^a-z0-9]++".join(k.split()) for k in sorted(known, key=lambda k: (-len(k), k)))
    return rf"(?:^|\n)[^a-z0-9\n]*+(?:{keys})(?=[^a-z0-9\n]*+(?:\n|\z))"


def _normal(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))


def scan(df: DataFrame, text_col: str = "text", sentences: dict[str, str] | None = None,
         rules: list[tuple[str, list[str]]] | None = None) -> DataFrame:
    """Add sentence_ids (array of string, in text order) and licences (sorted array of string) to ``df``."""
    clash = {"sentence_ids", "licences"} & {c.lower() for c in df.columns}
    if clash:
        raise ValueError(f"columns exist already: {sorted(clash)}")
    known = _known(sentences or SENTENCES)
    ordered = sorted(rules or RULES, key=lambda r: -len(r[1]))
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])

    runs = _runs(known)

    def cut(c: Column) -> Column:
        """Sentences in order that have a cue word."""
        c = F.regexp_replace(F.regexp_replace(c, LEADER, "$1"), SPDX, f"\n\n{SPDX_MARK} $1\n\n")
        for pattern, wording in TEMPLATES:
            c = F.regexp_replace(c, pattern, wording)
        parts = F.split(F.regexp_replace(c, END, "$1\n\n"), BLANK)
        return F.filter(parts, lambda s: s.rlike(f"(?i){CUES}"))

    def ids(s: Column) -> Column:
        whole = F.try_element_at(table, _normal(s))
        lines = F.transform(F.regexp_extract_all(F.lower(s), F.lit(runs), F.lit(0)), lambda x: F.try_element_at(table, _normal(x)))
        named = F.filter(F.split(F.substring(s, len(SPDX_MARK) + 2, 1 << 30), r"[()\s]+"), lambda x: x.rlike(r"^[A-Za-z0-9][A-Za-z0-9.+-]*$") & ~F.upper(x).isin("AND", "OR", "WITH"))
        return F.when(s.startswith(SPDX_MARK + " "), F.transform(named, lambda x: F.concat(F.lit("spdx:"), x))) \
            .when(whole.isNotNull(), F.array(whole)).otherwise(lines)

    found = F.when(F.col(text_col).rlike(f"(?i){CUES}"), F.flatten(F.transform(cut(F.col(text_col)), ids)))
    df = df.withColumn("sentence_ids", F.coalesce(found, F.array().cast("array<string>")))
    steps = F.array(*[F.struct(F.lit(name).alias("name"), F.lit("|" + "||".join(seq) + "|").alias("run")) for name, seq in ordered])
    # each identifier has its own bars, so runs next to each other share none
    start = F.struct(F.concat(F.lit("|"), F.array_join("sentence_ids", "||"), F.lit("|")).alias("rest"),
                     F.array().cast("array<string>").alias("names"))

    def step(acc: Column, r: Column) -> Column:
        run = r["run"]
        return F.when(F.contains(acc["rest"], run), F.struct(
            F.replace(acc["rest"], run, F.lit("#")).alias("rest"), F.array_append(acc["names"], r["name"]).alias("names"))).otherwise(acc)

    by_name = F.transform(F.filter("sentence_ids", lambda x: x.startswith("spdx:")), lambda x: F.substring(x, 6, 1 << 30))
    hit = F.when(F.size("sentence_ids") > 0, F.concat(F.aggregate(steps, start, step)["names"], by_name))
    return df.withColumn("licences", F.array_sort(F.array_distinct(F.coalesce(hit, F.array().cast("array<string>")))))


def scan_sql() -> str:
    """DuckDB SQL for ``op7``: the same cuts and look-ups, rules unrolled from the longest.

    It knows comment leaders, templates and identifier lines, and of runs of lines those of one line,
    so it holds for texts without headers whose sentences are wrapped behind a title line.
    """
    known = ", ".join(f"({_literal(k)}, {_literal(v)})" for k, v in _known(SENTENCES).items())
    ordered = sorted(RULES, key=lambda r: -len(r[1]))
    steps, prev = [], "seq"
    for i, (name, seq) in enumerate(ordered):
        run = _literal("|" + "||".join(seq) + "|")
        steps.append(f"r{i} AS (SELECT doc_id, sentence_ids, n, replace(rest, {run}, '#') AS rest, CASE WHEN contains(rest, {run}) "
                     f"THEN list_append(names, {_literal(name)}) ELSE names END AS names FROM {prev})")
        prev = f"r{i}"
    norm = "trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'))"
    plain = f"regexp_replace(regexp_replace(text, {_literal(LEADER.replace('*+', '*'))}, '\\1', 'g'), {_literal(SPDX)}, chr(10) || chr(10) || '{SPDX_MARK} \\1' || chr(10) || chr(10), 'g')"
    for pattern, wording in TEMPLATES:
        plain = f"regexp_replace({plain}, {_literal(pattern)}, {_literal(wording)}, 'g')"
    mark = len(SPDX_MARK) + 2
    return f"""
WITH known(k, id) AS (VALUES {known}),
cue AS (SELECT doc_id, text FROM documents WHERE regexp_matches(text, '(?i){CUES}')),
s AS (SELECT doc_id, unnest(parts) AS s, generate_subscripts(parts, 1) AS p FROM (
  SELECT doc_id, string_split_regex(regexp_replace({plain}, '([.!?:;])[ \\t\\n\\r\\f]+', '\\1' || chr(10) || chr(10), 'g'),
                                    '\\n[ \\t\\r]*\\n') AS parts FROM cue)),
hit AS (SELECT s.*, id FROM (SELECT * FROM s WHERE regexp_matches(s, '(?i){CUES}')) s LEFT JOIN known ON k = {norm.format('s')}),
line AS (SELECT doc_id, p, unnest(ls) AS l, generate_subscripts(ls, 1) AS q FROM (
  SELECT doc_id, p, string_split(s, chr(10)) AS ls FROM hit WHERE id IS NULL AND NOT starts_with(s, '{SPDX_MARK} '))),
spdx AS (SELECT doc_id, p, unnest(ls) AS l, generate_subscripts(ls, 1) AS q FROM (
  SELECT doc_id, p, list_filter(string_split_regex(substr(s, {mark}), '[()\\s]+'), lambda x: regexp_matches(x, '^[A-Za-z0-9][A-Za-z0-9.+-]*$')
    AND upper(x) NOT IN ('AND', 'OR', 'WITH')) AS ls FROM hit WHERE starts_with(s, '{SPDX_MARK} '))),
found AS (SELECT doc_id, p, 0 AS q, id FROM hit WHERE id IS NOT NULL
  UNION ALL SELECT doc_id, p, q, 'spdx:' || l FROM spdx
  UNION ALL SELECT doc_id, p, q, known.id FROM line JOIN known ON k = {norm.format('l')}),
seq AS (SELECT doc_id, string_agg(id, ',' ORDER BY p, q) AS sentence_ids, count(*) AS n,
  '|' || string_agg(id, '||' ORDER BY p, q) || '|' AS rest, CAST([] AS VARCHAR[]) AS names FROM found GROUP BY doc_id),
{', '.join(steps)}
SELECT d.doc_id, coalesce(f.n, 0) AS n_sentences, coalesce(f.sentence_ids, '') AS sentence_ids,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(f.names, list_transform(list_filter(string_split(f.sentence_ids, ','),
    lambda x: starts_with(x, 'spdx:')), lambda x: substr(x, 6))))), ','), '') AS licences
FROM documents d LEFT JOIN {prev} f ON d.doc_id = f.doc_id"""
