import duckdb
import pandas as pd

from flowaudit.llm.licenses import NOTICES, scan, scan_sql

MIT = NOTICES[10][1]
TEXTS = [
    None, "", " \n", "released under the MIT licence", "Copyright (c) 2020 A. Person\n" + MIT, "© 2021 B\n\n" + MIT.upper(),
    MIT.replace("sublicense", "sub-licence").replace("\n", " "), "prose\nReleased under the MIT License!\nmore",
    "Licensed under CC BY‑NC 4.0", "Released under the MIT License. Indeed", "Copyright 2020\nx", "copyright holders\ny",
    "Released under the MIT License.\nReleased  under the MIT License.", "word " * 60000 + "\nReleased under the MIT License.",
]


def test_matches_sql(spark):
    rows = list(enumerate(TEXTS)) + [(7, TEXTS[7]), (None, TEXTS[3])]
    df = spark.createDataFrame([(d, t, "l", 1) for d, t in rows], "doc_id long, text string, license string, line int")
    got = sorted(map(str, map(tuple, scan(df).collect())))
    documents = pd.DataFrame(rows, columns=["doc_id", "text"]).astype({"doc_id": "Int64"})      # noqa: F841
    assert got == sorted(map(str, duckdb.sql(scan_sql()).fetchall()))
    found = {(r.doc_id, r.unit, r.license) for r in scan(df).collect()}
    assert {(3, "text", "MIT"), (4, "text", "MIT"), (5, "text", "MIT"), (6, "text", "MIT"), (7, "line", "MIT"),
            (8, "text", "CC-BY-NC-4.0"), (13, "line", "MIT")} <= found
    assert not {d for d, *_ in found} & {0, 1, 2, 9, 10, 11}
    assert scan(df.where("false")).collect() == []


def _license_files():
    """Usual LICENSE files: (id, text); the bodies are wrapped otherwise than in the table."""
    from pathlib import Path
    from textwrap import fill

    import flowaudit.llm.licenses as L
    texts = Path(L.__file__).parent / "license_texts"
    head = "Copyright (c) 2020 X\n\n"
    wrap = lambda t, w: "\n\n".join(fill(p, w) for p in t.split("\n\n"))            # noqa: E731
    isc = NOTICES[11][1]
    bsd = {n: t for n, t in reversed(NOTICES[12:]) if n.startswith("BSD-")}
    out = [("MIT", "MIT License\n\n" + head + wrap(MIT, 76)), ("MIT", "The MIT License (MIT)\n\n" + head + MIT),
           ("ISC", "ISC License\n\n" + head + wrap(isc, 70))]
    for n, t in bsd.items():
        title = f"BSD {n[4]}-Clause License"
        body = t[t.index("Redistribution and use"):]
        out += [(n, f"{title}\n\n{head}All rights reserved.\n\n{wrap(body, 60 + n_)}") for n_ in (0, 7, 15)]
    for p in sorted(texts.glob("*.txt")):
        out.append((p.stem, p.read_text()))
        out.append((p.stem, p.read_text().rstrip("\n").replace("\n", "\r\n")))
    apache = (texts / "Apache-2.0.txt").read_text()
    gpl3 = (texts / "GPL-3.0.txt").read_text()
    return out + [("Apache-2.0", apache[:apache.index("APPENDIX")]), ("GPL-3.0", gpl3[gpl3.index("Preamble"):])]


def test_license_files(spark):
    files = _license_files()
    assert {"Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "GPL-2.0", "GPL-3.0", "ISC", "MIT", "MPL-2.0"} \
        <= {n for n, _ in files}
    rows = [(i, t) for i, (_, t) in enumerate(files)]
    got = sorted(map(tuple, scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    documents = pd.DataFrame(rows, columns=["doc_id", "text"])                       # noqa: F841
    assert got == sorted(duckdb.sql(scan_sql()).fetchall())
    found = {d: n for d, unit, _, n, _ in got if unit == "text"}
    assert [(i, n) for i, (n, _) in enumerate(files) if found.get(i) != n] == []


HEADERS = ["Copyright (c) Microsoft Corporation.", "Copyright The Foo Authors", "(C) Copyright 2020 X", "Portions Copyright 2020 X",
           "Copyright (c) Facebook, Inc. and its affiliates. All rights reserved.", "© Copyright X", "Portions © 2020 X",
           "Copyright Ada Lovelace", "Copyright <YEAR> <COPYRIGHT HOLDER>", "(c) 2020 X", "Copyright by X", "Copyright (c)"]


def test_copyright_headers(spark):
    from textwrap import fill

    from flowaudit.llm.licenses import _files
    full = dict(reversed([x for x in _files()]))
    texts = [(i, h + "\n\n" + MIT) for i, h in enumerate(HEADERS)]
    apache = full["Apache-2.0"]
    texts.append((50, MIT.replace("BE LIABLE", "WILFULLY BE LIABLE").replace("WILFULLY", "wilful")))
    # lines of running text that begin with "copyright" stay: every wrapping of a licence is the same licence
    bsd = next(t for n, t in NOTICES if n == "BSD-3-Clause" and "Redistribution and use" in t)
    texts += [(100 + w, fill(MIT, w)) for w in range(20, 80)] + [(200 + w, fill(bsd, w)) for w in range(20, 80)]
    texts += [(300, apache.replace("[yyyy] [name of copyright owner]", "2020 X")),
              (301, apache.replace("Copyright [yyyy] [name of copyright owner]", "Copyright The Foo Authors"))]
    known = NOTICES + [("odd", MIT.replace("BE LIABLE", "willful BE LIABLE"))]
    got = sorted(map(tuple, scan(spark.createDataFrame(texts, "doc_id long, text string"), known).collect()))
    documents = pd.DataFrame(texts, columns=["doc_id", "text"])                      # noqa: F841
    assert got == sorted(duckdb.sql(scan_sql(known)).fetchall())
    found = {d: n for d, unit, _, n, _ in got if unit == "text"}
    want = {i: "odd" if i == 50 else "MIT" if i < 200 else "BSD-3-Clause" if i < 300 else "Apache-2.0" for i, _ in texts}
    assert {i: n for i, n in want.items() if found.get(i) != n} == {}
