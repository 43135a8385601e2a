"""License scans: spans of consecutive words against licence templates by the Dice coefficient over sets of word bigrams.

Both sides are normalised alike: words are runs of ASCII letters (lower-cased), ASCII digits and non-ASCII characters, so line
breaks, blank lines, comment markers and layout play no part. For every template and every word of a text the span that
begins there and reaches the highest coefficient is looked for; spans begin and end with bigrams of the template (others would
not raise it). Of all that reach the threshold t the best are taken, in the order of score, template and place, and spans that
overlap a taken one are dropped.

Size bounds prune this without loss. A template of s bigrams needs at least t s / (2 - t) of them in a span, and a span has
at most s (2 - t) / t distinct bigrams, so one that crosses more than 2 s (1 - t) / t distinct foreign bigrams cannot reach t.
The places of a template's bigrams are cut where that is certain; groups with too few distinct ones are dropped, and only the
rest is grown, an end for each new bigram of the template.

All bigrams of a batch are coded at once; the templates (a bounded parameter) go to the tasks. There is no shuffle.

Rules for odd rows: a null text and a text of fewer than two words have no bigrams and match nothing. Ties go to the smaller
template id, then the earlier and shorter span; a notice that is repeated matches at each place. Equal rows give equal rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.llm import textcode as tc
from churnspark.llm.tables import computed, small_batches

THRESHOLD = 0.8
MOST_TEMPLATE_BYTES = 8 << 20
MADE = "n_words long, matches array<struct<license:string,score:double,begin:int,end:int>>"

# Notices and texts of common licences.
_BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, "
    "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT "
    "SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
    "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
    "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
TEMPLATES = {
    "Apache-2.0-short": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License."),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
        "the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. " + _BSD_END),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
        "the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission. " + _BSD_END),
    "BSD-3-Clause-short": "Released under the 3-Clause BSD License.",
    "CC0-1.0-short": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "CC-BY-4.0-short": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0-short": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0-short": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0-short": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
        "details. You should have received a copy of the GNU General Public License along with this program. If not, see "
        "<https://www.gnu.org/licenses/>."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "
        "\"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
        "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL "
        "DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
        "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
        "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
        "non-commercial, and by any means."),
    "MIT-short": "Released under the MIT License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
        "this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS "
        "PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
        "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
}


@dataclass
class Index:
    """Bigram sets of the templates, sizes ascending, and all their bigrams."""

    names: list[str]
    sets: list[np.ndarray]
    sizes: np.ndarray
    codes: np.ndarray
    member: np.ndarray  # [template, code]

    @staticmethod
    def of(templates: dict[str, str]) -> Index:
        if sum(map(len, templates.values())) > MOST_TEMPLATE_BYTES:
            raise ValueError("templates are sent to every task: scan with parts of the set, one after the other")
        found = []
        for name, text in templates.items():
            codes = np.unique(tc.Words([text.encode()], tc.NORMAL).windows(2)[0])
            if len(codes):
                found.append((len(codes), name, codes))
        found.sort(key=lambda x: x[:2])
        codes = np.unique(np.concatenate([c for _, _, c in found])) if found else np.empty(0, np.uint64)
        member = np.array([np.isin(codes, c, assume_unique=True) for _, _, c in found]).reshape(len(found), len(codes))
        return Index([n for _, n, _ in found], [c for _, _, c in found], np.array([k for k, _, _ in found], int), codes, member)


def bounds(size: int, threshold: float) -> tuple[int, int, int]:
    """For a template of ``size`` bigrams: fewest common ones, most distinct ones and most foreign ones of a span that reaches the threshold."""
    return (int(np.ceil(threshold * size / (2 - threshold) - 1e-9)), int(size * (2 - threshold) / threshold + 1e-9),
            int(2 * size * (1 - threshold) / threshold + 1e-9))


def _before(code: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The place of the same bigram before each place of a text, -1 without one."""
    order = np.argsort(code, kind="stable")
    same = (code[order[1:]] == code[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
    before = np.full(len(code), -1)
    before[order[1:][same]] = order[:-1][same]
    return before


def _grown(own: np.ndarray, before: np.ndarray, size: int, threshold: float) -> Iterator[tuple[float, int, int]]:
    """(score, first, last bigram) of the best span from every place in ``own``, the places of a template's bigrams."""
    low, high = int(own[0]), int(own[-1])
    ours = np.zeros(high - low + 1, bool)
    ours[own - low] = True
    seen, most = before[low:high + 1], bounds(size, threshold)[1]
    for begin in own.tolist():
        width = 4 * size + 8
        while True:  # until nothing more can be won: all bigrams of the template, too many distinct ones, or the end
            end = min(begin + width, high + 1)
            new = seen[begin - low:end - low] < begin
            distinct = np.cumsum(new)
            last = np.flatnonzero(new & ours[begin - low:end - low])
            if end > high or distinct[-1] > most or len(last) == size:
                break
            width *= 2
        common, all_ = np.arange(1, len(last) + 1), distinct[last] + size
        best = int(np.argmax(common / all_))
        if 200 * common[best] >= round(100 * threshold) * all_[best]:
            yield float(2 * common[best] / all_[best]), begin, begin + int(last[best])


def spans(code: np.ndarray, text: np.ndarray, index: Index, threshold: float) -> list[tuple[float, str, int, int]]:
    """(-score, template, first, last bigram) of the best span from every place that has one."""
    out: list[tuple[float, str, int, int]] = []
    if not len(index.codes) or not len(code):
        return out
    which = np.minimum(np.searchsorted(index.codes, code), len(index.codes) - 1)
    hits = np.flatnonzero(index.codes[which] == code)
    which = which[hits]
    before = _before(code, text)
    apart = np.where(before < 0, len(code), np.arange(len(code)) - before)
    fresh: dict[int, np.ndarray] = {}
    for k, (name, size) in enumerate(zip(index.names, index.sizes.tolist())):
        need, _, foreign = bounds(size, threshold)
        at = hits[index.member[k, which]]
        if len(at) < need:
            continue
        # A gap is surely too wide if more than ``foreign`` of its first bigrams do not occur before in it.
        width = 2 * foreign + 2
        if width not in fresh:
            fresh[width] = np.concatenate([[0], np.cumsum(apart >= width)])
        head = at[:-1] + 1
        wide = (at[1:] - head >= width) & (fresh[width][np.minimum(head + width, len(code))] - fresh[width][head] > foreign)
        heads = np.concatenate([[0], np.flatnonzero(wide | (text[at[1:]] != text[at[:-1]])) + 1])
        tails = np.concatenate([heads[1:], [len(at)]])
        distinct = np.add.reduceat((before[at] < np.repeat(at[heads], tails - heads)).astype(np.int64), heads)
        for g in np.flatnonzero(distinct >= need).tolist():
            out += [(-score, name, a, b) for score, a, b in _grown(at[heads[g]:tails[g]], before, size, threshold)]
    return out


def _slice(texts: list[bytes], index: Index, threshold: float) -> tuple[list[int], list[list[dict]]]:
    w = tc.Words(texts, tc.NORMAL)
    matches: list[list[dict]] = [[] for _ in texts]
    code, text, first = w.windows(2)
    taken = np.zeros(len(w.begin), bool)
    for score, name, a, b in sorted(spans(code, text, index, threshold)):
        one, two = int(first[a]), int(first[b]) + 1
        if taken[one:two + 1].any():
            continue
        taken[one:two + 1] = True
        i = int(text[a])
        begin, end = int(w.begin[one] - w.offset[i]), int(w.end[two] - w.offset[i])
        matches[i].append({"license": name, "score": -score, "begin": len(texts[i][:begin].decode("utf-8", "replace")),
                           "end": len(texts[i][:end].decode("utf-8", "replace"))})
    return np.diff(w.first).tolist(), matches


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD, text_col: str = "text",
         keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns unless given) with n_words and matches: template, score and place (characters), best first.

    Columns of ``docs`` that are called like the two are replaced.
    """
    small_batches(docs.sparkSession)
    index = Index.of(templates)

    def find(texts: list) -> list[list]:
        out = [[], []]
        for _, some in tc.chunks(pd.DataFrame(index=range(len(texts))), tc.encoded(texts)):
            for column, values in zip(out, _slice(some, index, threshold)):
                column += values
        return out

    return computed(docs, [F.col(f"`{text_col}`").cast("string")], find, MADE, keep)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_matches, license and score of the best match (ties: smaller name), its place in the text."""
    out = scan(docs, keep=["doc_id"])
    best = F.array_min(F.transform("matches", lambda m: F.struct(
        (-m["score"]).alias("s"), m["license"].alias("license"), m["begin"].alias("begin"), m["end"].alias("end"))))
    return out.select("doc_id", "n_words", F.size("matches").cast("long").alias("n_matches"), best["license"].alias("license"),
                      F.round(-best["s"], 6).alias("score"), best["begin"].alias("begin"), best["end"].alias("end"))
