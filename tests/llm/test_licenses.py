import random
import re
import textwrap

import pytest

from corpusmill.llm import licenses as L


def grams(text):
    w = re.findall("[a-z0-9]+", text.lower())
    return tuple(dict.fromkeys(f"{a} {b}" for a, b in zip(w, w[1:], strict=False)))


def brute(text, p):
    """Every unit against every template, without pruning."""
    text = text or ""
    units = {*text.split("\n"), *re.split(r"\n|(?<=[.!?])\s+", text), text}
    found, n = [], 0
    for g in {grams(u) for u in units if grams(u)}:
        own = []
        for name, t in p.templates:
            b = set(grams(t))
            both = len(b & set(g))
            if 200 * both >= p.dice * (len(b) + len(g)):
                own.append((-2.0 * both / (len(b) + len(g)), name))
        found += own
        n += bool(own)
    found.sort()
    return (found[0][1] if found else None, -found[0][0] if found else 0.0, n, ",".join(sorted({m for _, m in found})))


def damaged(rng, text):
    words = text.split()
    for _ in range(rng.randrange(4)):
        at = rng.randrange(len(words))
        words[at:at + rng.randrange(2)] = rng.choice([[], ["thing"], ["THE"], ["license,"]])
    return " ".join(words)


@pytest.mark.parametrize("dice", [75, 50])
def test_results_match_brute_force(docs, dice):
    rng, p = random.Random(dice), L.Licenses(dice=dice)
    texts = [None, "", " . ", "License", "no notice at all", "Licensed  under CC-BY 4.0!", "\n".join(t for _, t in L.TEMPLATES),
             ". ".join(t for _, t in L.TEMPLATES[:4]), "word " * 100_000 + "\nReleased under the MIT License.\n"]
    for _ in range(80):
        name, t = rng.choice(L.TEMPLATES)
        before = "Some words before. " * rng.randrange(3)
        texts.append(before + damaged(rng, t) + rng.choice(["", ".", "\nmore text here"]))
    texts += texts[9:12]
    got = {r["doc_id"]: tuple(r)[1:] for r in L.scan(docs(list(enumerate(texts)), extra=True), p).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        name, best, n, names = brute(t, p)
        assert got[i] == (name, pytest.approx(best), n, names), t


def test_every_template_finds_itself(docs):
    rows = [(i, f"Intro line\n{t.upper()}.\nend") for i, (_, t) in enumerate(L.TEMPLATES)]
    got = {r["doc_id"]: r for r in L.scan(docs(rows)).collect()}
    assert all(name in got[i]["licenses"].split(",") and got[i]["dice"] == 1.0 for i, (name, _) in enumerate(L.TEMPLATES))


def test_native_plan_and_empty_table(spark, docs):
    plan = L.scan(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert L.scan(docs([])).collect() == []


def wrapped(text, width, mark=""):
    return "\n".join(mark + line for line in textwrap.wrap(text, width))


def test_notices_wrapped_at_any_width_inside_long_documents(docs):
    rng = random.Random(6)
    prose = lambda n: "\n".join(" ".join(rng.choice("the of in any software copy or to was river".split()) for _ in range(11))
                                for _ in range(n))
    mit = "MIT License\n\nCopyright (c) 2020 Some One\n\n{}\n\n{}"
    bsd = "Copyright (c) 2011, Some One. All rights reserved.\n\n{}"
    notices = [("MIT", lambda w, m: mit.format(wrapped(L.MIT_GRANT, w, m), wrapped(L.MIT_REST, w, m))),
               ("MIT", lambda w, m: wrapped(L.MIT_GRANT, w, m)),
               ("BSD", lambda w, m: bsd.format(wrapped(f"{L.BSD_TWO} {L.BSD_REST}".replace(
                   "THE COPYRIGHT HOLDERS AND CONTRIBUTORS", "SOME ONE"), w, m))),
               ("GPL-3.0", lambda w, m: wrapped(L.GNU[1][2], w, m)),
               ("AGPL-3.0", lambda w, m: wrapped(L.GNU[3][2] + " " + L.GNU_REST.format(L.GNU[3][1]), w, m)),
               ("Apache-2.0", lambda w, m: wrapped(L.APACHE, w, m))]
    cases = [(name, make(w, m)) for name, make in notices for w, m in ((79, ""), (60, " * "), (30, "# "))]
    rows = [(i, f"{prose(300)}\n{t}\n{prose(300)}") for i, (_, t) in enumerate(cases)]
    n = len(rows)
    rows += [(n, prose(600)), (n + 1, prose(500).replace("\n", " ") + " " + L.MIT_GRANT.replace("\n", " ") + " and " + prose(500).replace("\n", " "))]
    got = {r["doc_id"]: r for r in L.scan(docs(rows)).collect()}
    for i, (name, t) in enumerate(cases):
        assert got[i]["license"] == name and got[i]["dice"] >= 0.75 and got[i]["n_units"] >= 1, (t, got[i])
    assert got[n]["license"] is None and got[n + 1]["license"] == "MIT"


@pytest.mark.parametrize("dice", [75, 50])
def test_passages_match_every_window(docs, dice):
    rng = random.Random(dice)
    p = L.Licenses(templates=(("A", "one two three four five six seven eight"), ("B", "four five nine ten one two")), dice=dice)
    rows = [(i, "\n".join(" ".join(rng.choice("one two three four five six seven eight nine ten x y".split()[:rng.choice([5, 8, 12])])
                                   if rng.random() < 0.4 else "one two three four five six seven eight nine ten".split()[(j + k) % 10]
                                   for k in range(rng.randrange(1, 5))) for j in range(0, rng.randrange(4, 40), 3)))
            for i in range(60)]
    got = {r["doc_id"]: r for r in L.scan(docs(rows), p).collect()}
    through = 0
    for i, text in rows:
        units = brute(text, p)
        ws = [(w, k) for k, line in enumerate(text.split("\n")) for w in line.split()]
        best = [(units[1], units[0])] if units[0] else []
        for name, t in p.templates:
            b = set(grams(t))
            if name in units[3].split(","):
                continue
            for s in range(len(ws)):
                for e in range(s + 2, min(len(ws), s + 2 + 2 * (len(b) * (200 - dice) // dice)) + 1):
                    g = set(grams(" ".join(w for w, _ in ws[s:e])))
                    if ws[s][1] != ws[e - 1][1] and 200 * len(b & g) >= dice * (len(b) + len(g)):
                        best.append((2 * len(b & g) / (len(b) + len(g)), name))
        names = ",".join(sorted({m for _, m in best} | {*filter(None, units[3].split(","))}))
        through += names != units[3]
        assert got[i]["licenses"] == names, text
        assert got[i]["dice"] == pytest.approx(max(best)[0] if best else 0.0), text
    assert through > 5
