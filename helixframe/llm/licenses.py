"""License scan by sentence rules.

A text is split into pieces at sentence ends, semicolons and line ends, each is
normalised (lower case, every run of other characters than letters and digits
one space), and a piece, or a run of pieces that no sentence end or blank line
parts, is looked up in the map from known license sentences to their
identifiers. So hard-wrapped notices, with comment marks or without, read as
one line does. The sequence of identifiers is then matched against ordered rules: a rule names a license for a run of
identifiers and uses that run up, so longer, more specific rules come first.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame

from helixframe.llm.textbytes import LOWER

# fixed values: identifiers of known license sentences in normal form
SENTENCES = [
    ("apache_line", "licensed under the apache license version 2 0"),
    ("apache_grant", "licensed under the apache license version 2 0 the license"),
    ("apache_use", "you may not use this file except in compliance with the license"),
    ("apache_copy", "you may obtain a copy of the license at"),
    ("apache_warranty", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("apache_see", "see the license for the specific language governing permissions and limitations under the license"),
    ("mit_line", "released under the mit license"),
    ("mit_title", "the mit license"),
    ("mit_title_spdx", "mit license"),
    ("mit_grant", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("mit_notice", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("gpl3_line", "this work is licensed under the gnu general public license version 3"),
    ("gpl_terms", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl2_terms", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("gpl_received", "you should have received a copy of the gnu general public license along with this program"),
    ("ccbync_line", "licensed under cc by nc 4 0"),
    ("ccby_line", "licensed under cc by 4 0"),
    ("ccbysa_line", "licensed under cc by sa 4 0"),
    ("spdx_mit", "spdx license identifier mit"),
    ("spdx_apache", "spdx license identifier apache 2 0"),
    ("spdx_gpl3", "spdx license identifier gpl 3 0 only"),
    ("bsd_grant", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd_source", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd_binary", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd_names", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd_as_is", "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"),
    ("bsd_liability", "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"),
    ("mit_as_is", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("mit_liability", "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    ("isc_grant", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("bsd0_grant", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("isc_as_is", "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"),
    ("mpl2_notice", "this source code form is subject to the terms of the mozilla public license v"),
    ("mpl2_copy", "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0"),
    ("mpl2_copy_tls", "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0"),
    ("gpl_warranty", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("gpl_see", "see the gnu general public license for more details"),
    ("lgpl21_terms", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version"),
    ("lgpl3_terms", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("lgpl_warranty", "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("lgpl_see", "see the gnu lesser general public license for more details"),
    ("lgpl_received", "you should have received a copy of the gnu lesser general public license along with this library"),
    ("agpl_terms", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("agpl_see", "see the gnu affero general public license for more details"),
    ("agpl_received", "you should have received a copy of the gnu affero general public license along with this program"),
    ("epl1_notice", "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 which accompanies this distribution and is available at http www eclipse org legal epl v10 html"),
    ("epl2_notice", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0"),
    ("cc0_dedication", "to the extent possible under law the author s have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide"),
    ("cc0_warranty", "this software is distributed without any warranty"),
    ("cc0_received", "you should have received a copy of the cc0 public domain dedication along with this software"),
    ("unlicense_free", "this is free and unencumbered software released into the public domain"),
    ("unlicense_anyone", "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means"),
    ("zlib_as_is", "this software is provided as is without any express or implied warranty"),
    ("zlib_liability", "in no event will the authors be held liable for any damages arising from the use of this software"),
    ("zlib_grant", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions"),
    ("boost_line", "distributed under the boost software license version 1 0"),
]

# fixed values: identifiers of the public license list that tags name; those with a line above are left out
TAGS = [
    "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0", "EPL-1.0", "EPL-2.0",
    "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-or-later", "ISC", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MPL-2.0",
    "Unlicense", "Zlib",
]
SENTENCES += [("spdx_" + re.sub("[^a-z0-9]+", "_", t.lower()), "spdx license identifier " + re.sub("[^a-z0-9]+", " ", t.lower())) for t in TAGS]

# fixed values: ordered rules over the identifiers
RULES = [
    ("Apache-2.0", ["apache_grant", "apache_use", "apache_copy", "apache_warranty", "apache_see"]),
    ("Apache-2.0-header", ["apache_grant", "apache_use"]),
    ("MIT", ["mit_title", "mit_grant", "mit_notice", "mit_as_is", "mit_liability"]),
    ("MIT", ["mit_title_spdx", "mit_grant", "mit_notice", "mit_as_is", "mit_liability"]),
    ("MIT", ["mit_title", "mit_grant", "mit_notice"]),
    ("MIT", ["mit_title_spdx", "mit_grant", "mit_notice"]),
    ("MIT-text", ["mit_grant", "mit_notice", "mit_as_is", "mit_liability"]),
    ("MIT-text", ["mit_grant", "mit_notice"]),
    ("BSD-3-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_names", "bsd_as_is", "bsd_liability"]),
    ("BSD-3-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_names"]),
    ("BSD-2-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_as_is", "bsd_liability"]),
    ("BSD-2-Clause", ["bsd_grant", "bsd_source", "bsd_binary"]),
    ("GPL-3.0-or-later", ["gpl_terms", "gpl_warranty", "gpl_see", "gpl_received"]),
    ("GPL-3.0-or-later", ["gpl_terms", "gpl_received"]),
    ("GPL-2.0-or-later", ["gpl2_terms", "gpl_warranty", "gpl_see", "gpl_received"]),
    ("GPL-2.0-or-later", ["gpl2_terms", "gpl_received"]),
    ("LGPL-2.1-or-later", ["lgpl21_terms", "lgpl_warranty", "lgpl_see", "lgpl_received"]),
    ("LGPL-2.1-or-later", ["lgpl21_terms", "lgpl_received"]),
    ("LGPL-3.0-or-later", ["lgpl3_terms", "lgpl_warranty", "lgpl_see", "lgpl_received"]),
    ("LGPL-3.0-or-later", ["lgpl3_terms", "lgpl_received"]),
    ("AGPL-3.0-or-later", ["agpl_terms", "gpl_warranty", "agpl_see", "agpl_received"]),
    ("AGPL-3.0-or-later", ["agpl_terms", "agpl_received"]),
    ("MPL-2.0", ["mpl2_notice", "mpl2_copy"]),
    ("MPL-2.0", ["mpl2_notice", "mpl2_copy_tls"]),
    ("ISC", ["isc_grant", "isc_as_is"]),
    ("0BSD", ["bsd0_grant", "isc_as_is"]),
    ("EPL-1.0", ["epl1_notice"]),
    ("EPL-2.0", ["epl2_notice"]),
    ("CC0-1.0", ["cc0_dedication", "cc0_warranty"]),
    ("Unlicense", ["unlicense_free", "unlicense_anyone"]),
    ("Zlib", ["zlib_as_is", "zlib_liability", "zlib_grant"]),
    ("BSL-1.0", ["boost_line"]),
    ("Apache-2.0-reference", ["apache_line"]),
    ("Apache-2.0-tag", ["spdx_apache"]),
    ("MIT-reference", ["mit_line"]),
    ("MIT-tag", ["spdx_mit"]),
    ("GPL-3.0-reference", ["gpl3_line"]),
    ("GPL-3.0-tag", ["spdx_gpl3"]),
    ("CC-BY-NC-4.0", ["ccbync_line"]),
    ("CC-BY-4.0", ["ccby_line"]),
    ("CC-BY-SA-4.0", ["ccbysa_line"]),
]
RULES += [(t + "-tag", ["spdx_" + re.sub("[^a-z0-9]+", "_", t.lower())]) for t in TAGS]

# fixed values: names that mentions of a license use, and the names of the public license list
MENTIONED = [
    ("apache license 2 0", "Apache-2.0"), ("apache 2 0 license", "Apache-2.0"), ("apache license version 2 0", "Apache-2.0"), ("mit license", "MIT"), ("isc license", "ISC"),
    ("bsd license", "BSD"), ("bsd 2 clause license", "BSD-2-Clause"), ("bsd 3 clause license", "BSD-3-Clause"), ("new bsd license", "BSD-3-Clause"), ("simplified bsd license", "BSD-2-Clause"),
    ("gnu general public license version 2", "GPL-2.0"), ("gnu general public license v2 0", "GPL-2.0"), ("gnu general public license version 3", "GPL-3.0"), ("gnu general public license v3 0", "GPL-3.0"),
    ("gplv2", "GPL-2.0"), ("gplv3", "GPL-3.0"), ("gnu lesser general public license version 2 1", "LGPL-2.1"), ("gnu lesser general public license version 3", "LGPL-3.0"),
    ("gnu affero general public license version 3", "AGPL-3.0"), ("mozilla public license 2 0", "MPL-2.0"), ("mozilla public license version 2 0", "MPL-2.0"), ("eclipse public license 1 0", "EPL-1.0"),
    ("eclipse public license 2 0", "EPL-2.0"), ("boost software license version 1 0", "BSL-1.0"), ("zlib license", "Zlib"), ("unlicense", "Unlicense"), ("artistic license 2 0", "Artistic-2.0"),
    ("creative commons attribution 4 0 international license", "CC-BY-4.0"), ("creative commons attribution sharealike 4 0 international license", "CC-BY-SA-4.0"),
    ("creative commons attribution noncommercial 4 0 international license", "CC-BY-NC-4.0"), ("creative commons attribution 3 0 unported license", "CC-BY-3.0"),
]
# fixed values: sentences that mention a license
MENTIONS = ["licensed under the {}", "released under the {}", "distributed under the {}", "available under the {}", "this project is licensed under the {}",
            "this work is licensed under the {}", "this work is licensed under a {}", "this software is released under the {}", "distributed under the terms of the {}",
            "licensed under the terms of the {}", "published under the {}"]
_GIVEN = {s for _, s in SENTENCES}
for _name, _license in MENTIONED:
    _id = "mention_" + re.sub("[^a-z0-9]+", "_", _name)
    for _k, _mention in enumerate(MENTIONS):
        if _mention.format(_name) not in _GIVEN:
            SENTENCES.append((f"{_id}_{_k}", _mention.format(_name)))
            RULES.append((f"{_license}-reference", [f"{_id}_{_k}"]))


def normal_form(sentence: str) -> str:
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()


#: A sentence end, or a line end before a line without letters and digits: no sentence runs over it.
_HARD = re.compile(r"[.!?](?=[ \t\r\n])|(?:\r\n?+|\n)(?=[^a-z0-9\r\n]*[\r\n])")
#: A border that a sentence may run over.
_SOFT = re.compile(r";(?=[ \t])|[\r\n]+")
_OTHER = re.compile("[^a-z0-9]+")


class Sentences:
    """Known sentences by normal form; what no sentence begins with is passed over at its first word."""

    def __init__(self, sentences: list[tuple[str, str]]):
        self.known = {}
        for i, s in sentences:
            self.known.setdefault(normal_form(s), i)
        self.firsts = {s.split(" ", 1)[0] for s in self.known}
        self.longest = max(map(len, self.known), default=0)
        # a sentence's longest word is in any text that has it, whatever stands between the words
        self.marks = re.compile("|".join(sorted(map(re.escape, {max(s.split(" "), key=len) for s in self.known})))) if self.known else None

    def find(self, text: str) -> list[str]:
        low = text.encode().translate(LOWER).decode()
        if self.marks is None or not self.marks.search(low):
            return []
        out = []
        for part in _HARD.split(low):
            pieces = [p for p in (_OTHER.sub(" ", x).strip() for x in _SOFT.split(part)) if p]
            at = 0
            while at < len(pieces):
                end = at + 1
                if pieces[at].split(" ", 1)[0] in self.firsts:
                    run, found = "", None
                    for k in range(at, len(pieces)):
                        run = f"{run} {pieces[k]}" if run else pieces[k]
                        if len(run) > self.longest:
                            break
                        if run in self.known:
                            found, end = self.known[run], k + 1
                    if found is not None:
                        out.append(found)
                at = end
        return out


def scan_licenses(df: DataFrame, key: str = "doc_id", text: str = "text",
                  sentences: list[tuple[str, str]] = SENTENCES, rules: list[tuple[str, list[str]]] = RULES) -> DataFrame:
    """Per row: ``key``, ``sentence_ids`` (in text order) and ``licenses`` (in rule order), both arrays.

    A rule counts once a text, and so does a license that several rules name;
    rules use up the runs of identifiers that they name, from the left. Pieces
    end at ``.!?;`` before white space and at line ends; a known sentence may
    run over semicolons and line ends, but not over ``.!?`` or a line without
    letters and digits. Of the sentences that begin at a piece the longest
    counts. Unknown sentences are skipped. Null, empty and unlicensed texts give
    empty arrays; repeated rows repeat; other columns are left out. Tables may
    have thousands of rows: a run of pieces is one lookup.
    """
    kind = dict(df.dtypes)[key]
    shipped = df.sparkSession.sparkContext.broadcast((Sentences(sentences), [(name, tuple(seq)) for name, seq in rules]))

    def run(batches):
        table, ordered = shipped.value
        for batch in batches:
            ids = [table.find(t or "") for t in batch.column(1).to_pylist()]
            named = [match_rules(i, ordered) for i in ids]
            lists = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, lists), pa.array(named, lists)], [key, "sentence_ids", "licenses"])

    return df.select(key, df[text].alias("_text")).mapInArrow(run, f"`{key}` {kind}, sentence_ids array<string>, licenses array<string>")


def match_rules(ids: list[str], rules: list[tuple[str, tuple[str, ...]]]) -> list[str]:
    """The licenses that ordered rules name; each rule takes its runs out of the sequence, which others don't close over."""
    if not ids:
        return []
    left: list[str | None] = list(ids)
    present, out = set(ids), []
    for name, seq in rules:
        if not present.issuperset(seq):
            continue
        at, hit = 0, False
        while at + len(seq) <= len(left):
            if tuple(left[at : at + len(seq)]) == seq:
                left[at : at + len(seq)] = [None]
                hit = True
            at += 1
        if hit and name not in out:
            out.append(name)
    return out
