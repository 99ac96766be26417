"""Operator 7: licence scans by canonical digests, in DataFrame operations only.

A text is brought to a canonical form (lower case, letters and digits only,
one spelling of words that licences spell in several ways, copyright lines
left out) and its SHA-256 digest is looked up among the digests of known
licences by a hash join.  Whole texts are looked up, and so is every line,
since many documents carry a licence notice as a line of its own.
"""

from __future__ import annotations

import pkgutil
import re

from pyspark.sql import DataFrame, SparkSession, functions as F

# Equivalent spellings, as in the matching guidelines for licence texts (canonical form last).
SPELLINGS = [
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("calibre", "caliber"), ("cancelled", "canceled"),
    ("catalogue", "catalog"), ("centre", "center"), ("emphasised", "emphasized"), ("favour", "favor"),
    ("favourite", "favorite"), ("fulfil", "fulfill"), ("fulfilment", "fulfillment"), ("initialise", "initialize"),
    ("judgement", "judgment"), ("labelling", "labeling"), ("labour", "labor"), ("licence", "license"),
    ("licenced", "licensed"), ("licences", "licenses"), ("maximise", "maximize"), ("modelled", "modeled"),
    ("non commercial", "noncommercial"), ("offence", "offense"), ("optimise", "optimize"),
    ("organisation", "organization"), ("organise", "organize"), ("per cent", "percent"), ("practise", "practice"),
    ("programme", "program"), ("realise", "realize"), ("recognise", "recognize"), ("signalling", "signaling"),
    ("sub license", "sublicense"), ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"),
]

# Notices and short licences in common use.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("MIT", "Released under the MIT License."),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE."""),
]

#: Titles that licences without a title of their own stand under in LICENSE files.
TITLES = {
    "BSD-2-Clause": ["BSD 2-Clause License", "The 2-Clause BSD License", "BSD License", "The BSD License",
                     'BSD 2-Clause "Simplified" License', "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The 3-Clause BSD License", "BSD License", "The BSD License",
                     'BSD 3-Clause "New" or "Revised" License', "New BSD License"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)", "ISC"],
    "MIT": ["MIT License", "The MIT License", "MIT License (MIT)", "The MIT License (MIT)", "MIT"],
    "Unlicense": ["The Unlicense", "Unlicense", "UNLICENSE"],
}
#: Files of license_texts/: id, where the text begins without its title (and preface), where an appendix may be left off.
FILES = [
    ("Apache-2.0", ["TERMS AND CONDITIONS FOR USE"], "END OF TERMS AND CONDITIONS"),
    ("BSL-1.0", ["Permission is hereby granted"], None),
    ("CC0-1.0", ["CC0 1.0 Universal", "Statement of Purpose"], None),
    ("GPL-2.0", ["Everyone is permitted", "Preamble"], "END OF TERMS AND CONDITIONS"),
    ("GPL-3.0", ["Everyone is permitted", "Preamble"], "END OF TERMS AND CONDITIONS"),
    ("LGPL-2.1", ["Everyone is permitted", "Preamble"], "END OF TERMS AND CONDITIONS"),
    ("LGPL-3.0", ["Everyone is permitted", "This version of the GNU"], None),
    ("MPL-2.0", ["1. Definitions"], None),
    ("Unlicense", [], None),
]
#: Addresses of the Free Software Foundation in older and newer copies of one text.
ADDRESS = r"51 Franklin Street, Fifth Floor, Boston, MA\s+02110-1301\s+USA"
ADDRESSES = ["59 Temple Place, Suite 330, Boston, MA 02111-1307 USA", "51 Franklin St, Fifth Floor, Boston, MA 02110-1301 USA"]

_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

{0}Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

{1}Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.

{2}THIS SOFTWARE IS PROVIDED BY {3} "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL {4} BE LIABLE FOR ANY
DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE
USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_NAMES = """{0}Neither the name of {1} nor the names of its contributors may be used to endorse or promote products derived from
this software without specific prior written permission.

"""
_OWNERS = ["the copyright holder", "the copyright owner", "the University", "the author"]
_DISCLAIMERS = [("THE COPYRIGHT HOLDERS AND CONTRIBUTORS", "THE COPYRIGHT HOLDER OR CONTRIBUTORS"),
                ("THE COPYRIGHT HOLDERS AND CONTRIBUTORS", "THE COPYRIGHT OWNER OR CONTRIBUTORS"),
                ("THE COPYRIGHT HOLDERS AND CONTRIBUTORS", "THE COPYRIGHT HOLDERS OR CONTRIBUTORS"),
                ("THE REGENTS AND CONTRIBUTORS", "THE REGENTS OR CONTRIBUTORS"),
                ("THE AUTHOR AND CONTRIBUTORS", "THE AUTHOR OR CONTRIBUTORS")]


def _bsd():
    for who, liable in _DISCLAIMERS:
        for one, two, three in (("1. ", "2. ", "3. "), ("", "", "")):
            yield "BSD-2-Clause", _BSD.format(one, two, "", who, liable)
            for owner in _OWNERS:
                yield "BSD-3-Clause", _BSD.format(one, two, _NAMES.format(three, owner), who, liable)


def _files():
    for name, starts, end in FILES:
        text = pkgutil.get_data(__package__, f"license_texts/{name}.txt").decode()
        whole_ = [text, *(re.sub(ADDRESS, a, text) for a in ADDRESSES)]
        whole_ += [t.replace("https://", "http://") for t in whole_] + [t.replace("http://", "https://") for t in whole_]
        for t in dict.fromkeys(whole_):
            cut = [t, *(t[t.index(x):] for x in starts)]
            yield from ((name, x) for x in cut)
            if end:
                yield from ((name, x[:x.index(end) + len(end)]) for x in cut)
                yield from ((name, x[:x.index(end)]) for x in cut)


def _full_texts():
    """(license, text) of whole licences: as published, without title, without appendix, under the usual titles."""
    plain = [*NOTICES[-2:], ("ISC", NOTICES[-1][1].replace("and/or distribute", "and distribute")), *_bsd(), *_files()]
    titled = [(name, f"{title}\n\n{text}") for name, text in plain for title in TITLES.get(name, [])]
    return [x for x in dict.fromkeys(plain + titled) if x not in NOTICES]


NOTICES += _full_texts()
#: Words that follow "copyright" in running text, where a line may be broken; a copyright line goes on with another one.
PROSE = ("also and are as assertions at because but by can claim claims disclaimer disclaimers doctrines exception exceptions "
         "for from has have held holder holders if in infringement interest interests is it its law laws legislation license "
         "licensed licenses like line lines may must notice notices of office on or ownership owned owner owners page patent "
         "permission permissions policy protected protection restrictions right rights shall should statement statements "
         "status term terms that this those to treaties treaty under was were which will with").split()


def _word_but(words) -> str:
    """Pattern for a word that is none of ``words`` (DuckDB's patterns have no lookahead)."""
    def rest(tails, start):
        heads = sorted({t[0] for t in tails if t})
        any_ = f"[^ {''.join(heads)}][^ ]*"
        return "(?:" + "|".join([any_] + [h + rest({t[1:] for t in tails if t[:1] == h}, False) for h in heads]
                              + ([] if start or "" in tails else [""])) + ")"
    return rest(set(words), True)


#: Lines left out: copyright lines (any length before a year or "by", else at most 16 words), and blank lines that held
#: spaces or a carriage return (CRLF files).
_HEAD = "(?:portions )?(?:c )?(?:copyright )+"
COPYRIGHT_LINE = "^ (?:" + "|".join([
    " *$", "all rights reserved $", "(?:portions )?c (?:19|20)[0-9][0-9] ",
    _HEAD + "(?:(?:c )*(?:(?:19|20)[0-9][0-9] |by )|(?:c )+$|(?:c )*(?:" + _word_but(PROSE + ["c", "the"]) + "|the "
    + _word_but(["library", "program", "software", "work"]) + ")(?: [^ ]+){0,15} $)"]) + ")"
#: A short pattern that every left-out line meets: Spark decodes a pattern anew for each string it is tried on.
MAYBE_LEFT_OUT = "^ ( *$|all r|portions c|c |copyright )"


def canonical_lines(text):
    """Lines of a text column: lower case words, each line with a space around every word; '' if it has none."""
    s = F.replace(F.lower(text), F.lit("©"), F.lit(" copyright "))
    s = F.concat(F.lit(" "), F.regexp_replace(s, r"[^\p{L}\p{N}\n]+", " "), F.lit(" "))
    s = F.replace(F.replace(s, F.lit("\n"), F.lit(" \n ")), F.lit("  "), F.lit(" "))
    for odd, usual in SPELLINGS:
        s = F.replace(s, F.lit(f" {odd} "), F.lit(f" {usual} "))
    return F.split(s, "\n")


def _keep(line):
    return (F.length(line) > 1) & ~(line.rlike(MAYBE_LEFT_OUT) & line.rlike(COPYRIGHT_LINE))


def _kept(lines):
    return F.filter(lines, _keep)


def digest(line):
    return F.sha2(F.trim(line), 256)


def whole(lines):
    """All kept lines as one canonical line."""
    return F.replace(F.array_join(lines, ""), F.lit("  "), F.lit(" "))


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | DataFrame = NOTICES) -> DataFrame:
    """digest, license: one row per known canonical text; the least id where several share one."""
    if not isinstance(known, DataFrame):
        known = spark.createDataFrame(known, "license string, text string")
    lines = _kept(canonical_lines(F.col("text").cast("string")))
    return known.where("license IS NOT NULL").select(digest(whole(lines)).alias("digest"), F.col("license").alias("license"), F.size(lines).alias("n")) \
        .where("n > 0").groupBy("digest").agg(F.min("license").alias("license"))


def scan(docs: DataFrame, known: list[tuple[str, str]] | DataFrame = NOTICES) -> DataFrame:
    """The known licences in ``docs`` (doc_id, text): doc_id, unit, line, license, digest.

    ``unit`` is ``text`` where the canonical form of the entire text is a known
    licence (line 0), and ``line`` where that of one line is (line: its number
    from 1, copyright and empty lines counted).  Null and empty texts match
    nothing.  Repeated rows are reported once each, rows without doc_id under
    null; other columns are ignored; an empty table gives an empty result.
    The table of known digests is joined by digest: Spark broadcasts it while
    it is below its threshold and deals both sides by digest beyond it.
    """
    lines = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        canonical_lines(F.col("text").cast("string")).alias("lines"))
    numbered = F.transform("lines", lambda x, i: F.struct(F.lit("line").alias("unit"), (i + 1).alias("line"), x.alias("body")))
    units = F.concat(
        F.array(F.struct(F.lit("text").alias("unit"), F.lit(0).alias("line"), whole(_kept(F.col("lines"))).alias("body"))),
        F.filter(numbered, lambda u: _keep(u["body"])))
    found = lines.select("doc_id", F.explode(units).alias("u")) \
        .where(F.length("u.body") > 1).select("doc_id", "u.unit", "u.line", digest(F.col("u.body")).alias("digest"))
    return found.join(known_digests(docs.sparkSession, known), "digest") \
        .select("doc_id", "unit", "line", "license", "digest")


def scan_sql(known: list[tuple[str, str]] = NOTICES, table: str = "documents") -> str:
    """DuckDB twin of :func:`scan`."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"                                  # noqa: E731
    body = "' ' || regexp_replace(replace(lower(text), '©', ' copyright '), '[^\\p{L}\\p{N}\\n]+', ' ', 'g') || ' '"
    body = f"replace(replace({body}, chr(10), ' ' || chr(10) || ' '), '  ', ' ')"
    for odd, usual in SPELLINGS:
        body = f"replace({body}, ' {odd} ', ' {usual} ')"
    keep = f"length(x) > 1 AND NOT regexp_matches(x, '{COPYRIGHT_LINE}')"
    whole_ = f"replace(array_to_string(list_filter(lines, lambda x: {keep}), ''), '  ', ' ')"
    rows = ", ".join(f"({quote(i)}, {quote(t)})" for i, t in known)
    return f"""
WITH known AS (
  SELECT sha256(trim({whole_})) AS digest, min(license) AS license
  FROM (SELECT license, string_split({body}, chr(10)) AS lines FROM (VALUES {rows}) v(license, text)) GROUP BY 1),
docs AS (SELECT doc_id, string_split({body}, chr(10)) AS lines FROM {table}),
units AS (
  SELECT doc_id, 'text' AS unit, 0 AS line, {whole_} AS body FROM docs
  UNION ALL
  SELECT doc_id, 'line', CAST(n AS INTEGER), body
  FROM (SELECT doc_id, unnest(lines) AS body, generate_subscripts(lines, 1) AS n FROM docs)
  WHERE length(body) > 1 AND NOT regexp_matches(body, '{COPYRIGHT_LINE}'))
SELECT doc_id, unit, line, license, digest
FROM (SELECT doc_id, unit, line, sha256(trim(body)) AS digest FROM units WHERE length(body) > 1) JOIN known USING (digest)"""
