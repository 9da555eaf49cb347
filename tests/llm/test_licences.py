"""The licence scan against a brute-force version that builds every unit's vector."""

import math
import random
import re
from collections import Counter

import pytest

from quillwork.llm import licences

G = random.Random(4)
VOCABULARY = ["".join(G.choice("abcdefgh") for _ in range(G.randint(2, 7))) for _ in range(200)] + ["the", "of", "software", "license", "copy"]


def prose(n, g=G):
    return " ".join(g.choice(VOCABULARY) for _ in range(n))


def terms(t):
    return [x for x in re.split("[" + re.escape(licences.APART) + " ]+", t.lower()) if x]


def units(text, keys):
    raw = text.split("\n")
    lines = [re.sub(licences.COMMENT_END, "", re.sub(licences.COMMENT, "", x)) for x in raw]
    h = next((i for i, x in enumerate(raw) if not re.search(licences.COMMENT, x) and x.strip()), len(raw))
    whole = "\n".join(lines)
    out = [whole, "\n".join(lines[:h]), *re.split(r"\n[ \t\r]*\n\s*", whole)]
    run = []
    for x in [*lines, ""]:
        if keys & set(terms(x)):
            out.append(x)
            run.append(x)
        elif run:
            out.append("\n".join(run))
            run = []
    return [(i, x) for i, x in enumerate(out) if terms(x)]


def brute(files, templates, least=0.6):
    """files: (rid, path, text). The keys only choose single lines and runs, so all terms of templates stand for them."""
    n = len(files)
    df = Counter(t for _, _, x in files for t in set(terms(x or "")))
    idf = lambda t: math.log((1 + n) / (1 + df[t]))
    vector = lambda x: {t: (1 + math.log(c)) * idf(t) for t, c in Counter(terms(x)).items()}
    norm = lambda v: math.sqrt(sum(w * w for w in v.values()))
    models = [(name, v, norm(v)) for name, v in ((a, vector(b)) for a, b in templates)]
    keys = {t for _, v, _ in models for t in v}
    own, alone = {}, set()
    for rid, _, text in files:
        for i, u in units(text or "", keys):
            v = vector(u)
            size = norm(v)
            for name, m, mn in models:
                c = round(sum(w * m.get(t, 0.0) for t, w in v.items()) / (size * mn), 6) if size and mn else 0.0
                if c >= least:
                    own[rid] = min(own.get(rid, (0.0, "")), (-c, name))
                    if i == 0 and c >= 0.85:
                        alone.add(rid)
    votes = {}
    for rid, path, _ in files:
        if rid in own and path and "/" in path and (rid in alone or re.match(r"(?i)^(licen[cs]e|copying)(\..*)?$", path.rsplit("/", 1)[1])):
            votes.setdefault(path.rsplit("/", 1)[0], Counter())[own[rid][1]] += 1
    dirs = {d: min((-k, name) for name, k in c.items())[1] for d, c in votes.items()}
    out = {}
    for rid, path, _ in files:
        d, got = path.rsplit("/", 1)[0] if path and "/" in path else None, (None, None)
        while d is not None:
            if d in dirs:
                got = (dirs[d], d)
                break
            d = d.rsplit("/", 1)[0] if "/" in d else None
        mine = own.get(rid)
        out[rid] = (mine[1] if mine else None, -mine[0] if mine else None, mine[1] if mine else got[0], None if mine else got[1])
    return out


def comment(text, width=70, mark="# "):
    out, line = [], ""
    for w in text.split():
        if len(line) + len(w) > width:
            out.append(line)
            line = ""
        line += " " * bool(line) + w
    return "\n".join(mark + x for x in [*out, line])


def fixture():
    t = dict(reversed([(name, x) for name, x in licences.TEMPLATES if len(x) > 300]))
    mit, gpl, apache, bsd = t["MIT"], t["GPL-3.0"], t["Apache-2.0"], t["BSD-3-Clause"]
    files = [
        ("a/LICENSE", "The MIT License (MIT)\n\nCopyright (c) 2020 Somebody\n\n" + mit), ("a/b/x.py", prose(60)), ("a/b/c/y.py", prose(30)),
        ("g/z.c", comment(gpl, mark=" * ").replace(" * ", "/* ", 1) + "\n */\n" + " ".join(f"code{i}" for i in range(90))), ("g/w.c", prose(20)),
        ("p/COPYING", "Apache License\nVersion 2.0, January 2004\n\n" + prose(300)), ("p/q/r.c", "int x;\n"), ("p/s.go", "// " + prose(5) + "\n\n" + comment(apache, mark="// ") + "\n\n" + prose(100)),
        ("n/1", prose(80) + "\nLicensed under CC BY-NC 4.0.\n" + prose(40)), ("n/2", "Licensed under CC BY-NC 4.0."), ("n/3", None), ("n/4", ""), ("n/5", " \n "), (None, bsd), ("flat", bsd),
        ("t/1", "Released under the MIT License."), ("t/2", "Licensed under the Apache License, Version 2.0."), ("t/3", prose(9)), ("t/u/v/w/4", prose(9)), ("n/1", prose(80)),
        ("m/LICENCE.txt", prose(200) + "\n" + comment(mit, mark="")), ("m/5", prose(50, random.Random(1))), ("m/5", prose(50, random.Random(1))),
    ]
    files += [(f"r/{i // 7}/{i}", prose(G.randint(1, 120))) for i in range(60)]
    return [(i, p, x) for i, (p, x) in enumerate(files)]


def rows(spark, files, templates):
    frame = spark.createDataFrame([(*f, "c", 1) for f in files], "_rid long, path string, text string, cosine string, _n long")
    shape = spark.createDataFrame(templates, "name string, notice string")
    return {r["_rid"]: (r.own_licence, r.cosine, r.licence, r.inherited_from) for r in licences.scan(frame, shape).collect()}


def test_scan(spark):
    files = fixture()
    got, want = rows(spark, files, licences.TEMPLATES), brute(files, licences.TEMPLATES)
    for rid, path, _ in files:
        assert got[rid][0] == want[rid][0] and got[rid][2:] == want[rid][2:], (path, got[rid], want[rid])
        assert got[rid][1] == (want[rid][1] if want[rid][1] is None else pytest.approx(want[rid][1], abs=2e-6))
    by = {p: got[i] for i, p, _ in files}
    assert by["a/LICENSE"][0] == "MIT" and by["a/b/c/y.py"][2:] == ("MIT", "a") and by["g/z.c"][0] == "GPL-3.0" and by["g/w.c"][2] is None
    assert by["p/COPYING"][0] == by["p/s.go"][0] == "Apache-2.0" and by["p/q/r.c"][2:] == ("Apache-2.0", "p") and by["m/5"][2:] == ("MIT", "m")
    assert by["n/2"][0] == "CC-BY-NC-4.0" and by["n/3"][2:] == ("CC-BY-NC-4.0", "n") and by["flat"][0] == "BSD-3-Clause"
    assert by["t/u/v/w/4"][2:] == ("Apache-2.0", "t")  # one vote each: the smaller name


def test_nothing(spark):
    files = fixture()[:5]
    assert all(v == (None, None, None, None) for v in rows(spark, files, []).values())
    assert rows(spark, [], licences.TEMPLATES) == {}


def test_query_of_repeated_and_null_ids(spark, tmp_path):
    data = [(1, "Released under the MIT License.", "s"), (1, "plain words here", "s"), (None, "others", None), (2, None, "s")]
    spark.createDataFrame(data, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(((r.doc_id or 0, r.path, r.licence) for r in licences.query(spark, str(tmp_path)).collect()), key=str)
    assert got == [(0, "none", None), (1, "s/0/0/1", "MIT"), (1, "s/0/0/1", "MIT"), (2, "s/0/0/2", "MIT")]
