"""Cover density by windows against a plain table of positions by items."""

import random

from sieve.operators.covers import cover_scores


def plain(hits, occ, n_pos):
    """Score of one pair: for each end the latest start, by clause the least of its items."""
    hits = sorted(hits)
    pos = [p for p, _ in hits]
    score, best = 0.0, -1
    for e in sorted({o[3] for o in occ}):
        p = -1
        for c, n in n_pos.items():
            last = [max((s for cc, i, s, x in occ if (cc, i) == (c, item) and x <= e), default=-1) for item in {i for cc, i, _, _ in occ if cc == c}]
            if len(last) == n:
                p = max(p, min(last))
        if p > best:
            best = p
            inside = [w for x, w in hits if p <= x <= e]
            span = pos.index(e) - pos.index(p)
            score += len(inside) / sum(1 / w for w in inside) / (1 + (e - p) - span)
    return score


def test_matches_plain_table(spark):
    r = random.Random(11)
    hits, occ, want = [], [], {}
    for q in range(6):
        clauses = {c: [r.choice((1, 1, 1, 2, 3)) for _ in range(r.randint(1, 4))] for c in range(r.randint(1, 3))}
        for d in range(40):
            n = r.randint(1, 60)
            mine, seen = [], set()
            for c, items in clauses.items():
                for i, size in enumerate(items):
                    for s in r.sample(range(1, n + 1), min(n, r.randint(0, 6))):
                        mine.append((c, i, s, s + size - 1))
                        seen.update(range(s, s + size))
            pair = [(p, r.choice((1.0, 0.4))) for p in sorted(seen)]
            hits += [(q, d, p, w) for p, w in pair]
            n_pos = {c: len(items) for c, items in clauses.items()}
            occ += [(q, d, *o, n_pos[o[0]]) for o in mine]
            if pair:
                want[q, d] = round(plain(pair, mine, n_pos), 9)
    h = spark.createDataFrame(hits, "query_id long, doc_id long, pos int, w double")
    o = spark.createDataFrame(occ, "query_id long, doc_id long, clause_id int, item_id int, start int, end int, n_pos int")
    assert {(x.query_id, x.doc_id): round(x.score, 9) for x in cover_scores(h, o).collect()} == want
    assert any(want.values())


def test_one_shuffle_and_no_python(spark):
    h = spark.createDataFrame([(1, 1, 1, 1.0)], "query_id long, doc_id long, pos int, w double")
    o = spark.createDataFrame([(1, 1, 0, 0, 1, 1, 1)], "query_id long, doc_id long, clause_id int, item_id int, start int, end int, n_pos int")
    df = cover_scores(h, o)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan and "Arrow" not in plan
    assert df.collect()[0].score == 1.0
