"""License scan by template markup.

A template is the wording of a license with two kinds of region marked:
``<<beginOptional>>...<<endOptional>>`` may be left out, and
``<<var;name="holder";words="1,8">>`` stands for that many words of any kind.  Each template is
compiled into an automaton over words; a place in a text is accepted only where every mandatory
word follows in order.  All automata run together over the words of a text.

Words are the runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z are lower-cased, so
punctuation and white space never matter.

Whole texts are matched of the MIT and BSD licenses; of Apache, GPL and Creative Commons only notices.  An
opening is a notice too: it says nothing of the clauses after it.

Null or empty texts have no words and no matches.  Extra columns are kept; ``n_words`` and
``matches`` are overwritten if the input has them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import bounded_batches

_SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
#: Lower-cases A-Z and turns every other separator into a space, byte by byte of UTF-8.
_TO_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else 0x20 if b in _SEPARATORS else b for b in range(256)
)
_MARK = re.compile(r'<<(beginOptional|endOptional|var;name="[^"]*";words="(\d+),(\d+)")>>')


@dataclass(frozen=True)
class Template:
    name: str
    label: str
    markup: str
    score: float  # how sure a match is: a bare phrase, a notice or opening, a whole license text
    base: bool = False


TEMPLATES = (
    Template("phrase-mit", "mit", "MIT License", 0.5, True),
    Template("phrase-apache", "apache", "Apache License", 0.5, True),
    Template("phrase-gpl", "gpl", "General Public License", 0.5, True),
    Template(
        "notice-mit", "mit-notice",
        'released<<beginOptional>> and distributed<<endOptional>> under the<<beginOptional>> terms of the<<endOptional>> MIT License', 0.9,
    ),
    Template("notice-mit-licensed", "mit-notice", "licensed under the<<beginOptional>> terms of the<<endOptional>> MIT License", 0.9),
    Template(
        "opening-mit", "mit-text",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of <<var;name="what";words="1,8">> '
        'and associated documentation files (the "<<var;name="noun";words="1,3">>"), to deal in the <<var;name="noun";words="1,3">> without restriction', 0.9,
    ),
    Template(
        "text-mit", "mit-whole",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of <<var;name="what";words="1,8">> '
        "and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice<<beginOptional>> (including the next paragraph)<<endOptional>> "
        "shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
        "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
        '<<var;name="holder";words="1,12">> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, '
        "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE", 1.0,
    ),
    Template(
        "notice-apache-2.0", "apache-2.0",
        "licensed under the<<beginOptional>> terms of the<<endOptional>> Apache License<<beginOptional>>,<<endOptional>> Version 2.0"
        "<<beginOptional>> (the License); you may not use this file except in compliance with the License<<endOptional>>", 0.9,
    ),
    Template(
        "notice-gpl-3.0", "gpl-3.0",
        "GNU<<beginOptional>> Lesser<<endOptional>><<beginOptional>> Affero<<endOptional>> General Public License"
        "<<beginOptional>> as published by the Free Software Foundation<<endOptional>><<beginOptional>>, either<<endOptional>>, version 3", 0.9,
    ),
    Template(
        "notice-gpl-2.0", "gpl-2.0",
        "GNU<<beginOptional>> Lesser<<endOptional>> General Public License"
        "<<beginOptional>> as published by the Free Software Foundation<<endOptional>><<beginOptional>>, either<<endOptional>>, version 2", 0.9,
    ),
    Template("notice-cc-by-nc", "cc-by-nc-4.0", "licensed under<<beginOptional>> a Creative Commons<<endOptional>> CC BY-NC 4.0", 0.9),
    Template("notice-cc-by-sa", "cc-by-sa-4.0", "licensed under<<beginOptional>> a Creative Commons<<endOptional>> CC BY-SA 4.0", 0.9),
    Template("notice-cc-by", "cc-by-4.0", "licensed under<<beginOptional>> a Creative Commons<<endOptional>> CC BY 4.0", 0.9),
    Template(
        "opening-bsd", "bsd-text",
        "Redistribution and use in source and binary forms, with or without modification, are permitted"
        "<<beginOptional>> (subject to the limitations in the disclaimer below)<<endOptional>> provided that the following conditions are met", 0.9,
    ),
    Template(
        "text-bsd", "bsd-whole",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "<<beginOptional>>1<<endOptional>> Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "<<beginOptional>>2<<endOptional>> Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
        "in the documentation and/or other materials provided with the distribution. "
        '<<beginOptional>><<beginOptional>>3<<endOptional>> Neither the name of <<var;name="holder";words="1,12">> nor the names of <<beginOptional>>its<<endOptional>> contributors '
        "may be used to endorse or promote products derived from this software without specific prior written permission.<<endOptional>> "
        'THIS SOFTWARE IS PROVIDED BY <<var;name="holder";words="1,12">> AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF '
        'MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL <<var;name="holder";words="1,12">> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, '
        "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
        "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF "
        "THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE", 1.0,
    ),
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TO_WORDS).split() if text else []


def parse(markup: str) -> list:
    """Nested regions: a word, ``("any", low, high)`` or ``("opt", [...])``."""
    out: list = []
    stack, at = [out], 0
    for m in [*_MARK.finditer(markup), None]:
        stack[-1].extend(words_of(markup[at : m.start() if m else len(markup)]))
        if m is None:
            break
        at = m.end()
        if m[1] == "beginOptional":
            stack.append([])
        elif m[1] == "endOptional":
            if len(stack) == 1:
                raise ValueError("endOptional without beginOptional")
            region = stack.pop()
            if region:
                stack[-1].append(("opt", region))
        else:
            stack[-1].append(("any", int(m[2]), int(m[3])))
    if len(stack) != 1:
        raise ValueError("beginOptional without endOptional")
    return out


class Automaton:
    """A word automaton for many templates: states hold what may follow, with empty moves resolved on compiling."""

    def __init__(self, templates=TEMPLATES):
        self.templates = tuple(templates)
        self.words: list[dict[bytes, set[int]]] = []
        self.any: list[set[int]] = []
        self.skip: list[set[int]] = []
        self.accepts: list[set[int]] = []
        start = self._state()
        self.required = []
        for k, t in enumerate(self.templates):
            parts = parse(t.markup)
            must = [p for p in parts if isinstance(p, bytes)]
            if not parts or not isinstance(parts[0], bytes):
                raise ValueError(f"template {t.name} must begin with a mandatory word")
            self.required.append(max(must, key=len))
            self.accepts[self._add(parts, start)].add(k)
        closed = [self._closure(s) for s in range(len(self.words))]
        self.start = closed[start]
        self.closed = closed
        self.first = frozenset(w for s in self.start for w in self.words[s])
        self.required = frozenset(self.required)
        self._memo: dict = {}

    def _state(self) -> int:
        self.words.append({})
        self.any.append(set())
        self.skip.append(set())
        self.accepts.append(set())
        return len(self.words) - 1

    def _add(self, parts: list, at: int) -> int:
        for p in parts:
            if isinstance(p, bytes):
                to = self._state()
                self.words[at].setdefault(p, set()).add(to)
                at = to
            elif p[0] == "any":
                ends = [at] if p[1] == 0 else []
                for n in range(1, p[2] + 1):
                    to = self._state()
                    self.any[at].add(to)
                    at = to
                    if n >= p[1]:
                        ends.append(at)
                for s in ends:
                    if s != at:
                        self.skip[s].add(at)
            else:
                to = self._add(p[1], at)
                end = self._state()
                self.skip[at].add(end)
                self.skip[to].add(end)
                at = end
        return at

    def _closure(self, s: int) -> frozenset:
        seen, todo = {s}, [s]
        while todo:
            for t in self.skip[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)

    def step(self, states: frozenset, word: bytes) -> frozenset:
        out: set = set()
        for s in states:
            for t in self.words[s].get(word, ()):
                out |= self.closed[t]
            for t in self.any[s]:
                out |= self.closed[t]
        return frozenset(out)

    def matches(self, words: list[bytes]) -> list[tuple[int, int, int]]:
        """(template, first word, end) with the longest end of each template at each place."""
        if not self.required.intersection(words):
            return []
        found = []
        for i, w in enumerate(words):
            if w not in self.first:
                continue
            states, best, j = self.start, {}, i
            while states and j < len(words):
                states = self.step(states, words[j])
                j += 1
                for s in states:
                    for k in self.accepts[s]:
                        best[k] = j
            found += [(k, i, end) for k, end in sorted(best.items())]
        return found

    def regex(self, k: int) -> str:
        """The same language as a regular expression over words that each end in a space (for SQL)."""

        def of(parts):
            return "".join(
                re.escape(p.decode()) + " " if isinstance(p, bytes)
                else f"(?:[^ ]+ ){{{p[1]},{p[2]}}}" if p[0] == "any"
                else f"(?:{of(p[1])})?"
                for p in parts
            )

        return of(parse(self.templates[k].markup))


MATCHES = "array<struct<template:string,label:string,base:boolean,score:double,start:bigint,end:bigint>>"
SCAN = f"struct<n_words:bigint,matches:{MATCHES}>"


def scan(docs: DataFrame, text: str = "text", templates=TEMPLATES) -> DataFrame:
    """Adds ``n_words`` and ``matches`` (template, label, base, score, first word and end of each place)."""
    bounded_batches(docs.sparkSession)
    templates = tuple(templates)
    machine: list[Automaton] = []

    @F.arrow_udf(SCAN)
    def run(texts: pa.Array) -> pa.Array:
        if not machine:
            machine.append(Automaton(templates))
        m = machine[0]
        out = []
        for x in texts.to_pylist():
            words = words_of(x)
            out.append(
                {
                    "n_words": len(words),
                    "matches": [
                        {"template": (t := m.templates[k]).name, "label": t.label, "base": t.base, "score": t.score, "start": i, "end": j}
                        for k, i, j in m.matches(words)
                    ],
                }
            )
        kind = pa.struct([("template", pa.string()), ("label", pa.string()), ("base", pa.bool_()), ("score", pa.float64()), ("start", pa.int64()), ("end", pa.int64())])
        return pa.array(out, pa.struct([("n_words", pa.int64()), ("matches", pa.list_(kind))]))

    held = docs.withColumn("__scan", run(F.col(text)))
    return held.withColumns({"n_words": F.col("__scan.n_words"), "matches": F.col("__scan.matches")}).drop("__scan")


def report(docs: DataFrame) -> DataFrame:
    """One row per document: words, places of the base phrases, labels of base and of all templates, best score."""
    m = scan(docs.select("doc_id", "text"))
    base = F.filter("matches", lambda x: x["base"])

    def labels(xs):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(xs, lambda x: x["label"]))), ",")

    return m.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda x: x["start"])).alias("first_word"),
        F.array_max(F.transform(base, lambda x: x["start"])).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda x: x["score"])), F.lit(0.0)).alias("score"),
    )


def report_sql() -> str:
    """DuckDB SQL for :func:`report` over ``documents``, made from the same templates."""
    m = Automaton()
    q = lambda s: "'" + s.replace("'", "''") + "'"
    base = [(k, t) for k, t in enumerate(m.templates) if t.base]
    tests = {k: f"regexp_matches(j, {q(' ' + m.regex(k))})" for k in range(len(m.templates))}
    places = {
        k: "list_filter(range(0, len(w)), lambda i: " + " AND ".join(f"w[i + {n + 1}] = {q(x.decode())}" for n, x in enumerate(parse(t.markup))) + ")"
        for k, t in base
    }
    every = "list_concat(" * (len(base) - 1) + places[base[0][0]] + "".join(f", {places[k]})" for k, _ in base[1:])
    labels = lambda ks: "array_to_string(list_sort(list_distinct(list_filter([" + ", ".join(f"CASE WHEN {tests[k]} THEN {q(m.templates[k].label)} END" for k in ks) + "], lambda x: x IS NOT NULL))), ',')"
    score = "greatest(0.0::DOUBLE, " + ", ".join(f"CASE WHEN {tests[k]} THEN {t.score}::DOUBLE ELSE 0.0::DOUBLE END" for k, t in enumerate(m.templates)) + ")"
    return f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
), j AS (SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS j FROM d),
p AS (SELECT doc_id, w, j, {every} AS b FROM j)
SELECT doc_id, len(w)::BIGINT AS n_words, len(b)::BIGINT AS n_base, list_min(b) AS first_word, list_max(b) AS last_word,
  {labels([k for k, _ in base])} AS base_labels, {labels(range(len(m.templates)))} AS labels, {score} AS score
FROM p"""
