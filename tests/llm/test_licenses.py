import re
from collections import Counter

from rxcover.llm import licenses as lc


def bag(x):
    w = [v for v in re.sub("[^a-z0-9]+", " ", x.lower()).split(" ") if v]
    return Counter(zip(w, w[1:]))


def brute(rows):
    out = []
    for d, text in rows:
        if text is None:
            continue
        units = [("line", i, x) for i, x in enumerate(text.split("\n"))]
        paras = re.split("\n\n+", text)
        units += [("paragraph", i, x) for i, x in enumerate(paras) if "\n" in x]
        units += [("text", 0, text)] if len(paras) > 1 else []
        for kind, i, x in units:
            a = bag(x)
            for name, t in lc.TEMPLATES.items():
                b = bag(t)
                n, m, s = sum(a.values()), sum(b.values()), sum((a & b).values())
                if n and 20 * s >= 8 * (n + m):
                    out.append((d, kind, i, name, n, s, 2.0 * s / (n + m)))
    return sorted(out, key=repr)


T = list(lc.TEMPLATES.values())
ROWS = [(1, "x\n" + T[0] + "\nmore text"), (2, T[1].replace(", ", ",\n")), (3, "First part.\n\n" + T[3].replace(" ", "\n", 3) + "\n\nend"),
        (4, None), (5, ""), (6, "one"), (7, "\n\n\n"), (8, T[2].upper() + "\n" + T[2]), (8, T[2].upper() + "\n" + T[2]), (None, T[4]),
        (9, ("MIT License " * 30000)), (10, T[4].replace("work", "text").replace("3", "2")), (11, "Licensed under the Apache License"),
        (12, T[6] + " " + T[6]), (13, "released under the mit license released under the mit license"), (14, "É " + T[7])]


def test_equals_brute_force(spark, make_docs):
    got = lc.scan(make_docs(ROWS, extra=("license", "n", "unit", "bigram")), lc.template_table(spark)).collect()
    assert sorted([tuple(r) for r in got], key=repr) == brute(ROWS)
    assert {r.doc_id for r in got} >= {1, 2, 3, 8, 14, None}


def test_empty_and_plan(spark, make_docs):
    t = lc.template_table(spark)
    assert lc.scan(make_docs([]), t).count() == 0
    assert lc.scan(make_docs(ROWS), t.limit(0)).count() == 0
    plan = lc.scan(make_docs(ROWS), t)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
