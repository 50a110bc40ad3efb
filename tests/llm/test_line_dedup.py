import numpy as np
import pytest

from sparkqc.llm import line_dedup as ld


def brute(rows, least):
    """Delete each line in a run of ``least`` words that stands at an earlier place too."""
    places = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    full = {i: [(p, x) for p, x in enumerate((rows[i][1] or "").split("\n")) if x.split()] for i in places}
    seen, gone = set(), {i: set() for i in places}
    for i in places:
        lines = full[i]
        for a in range(len(lines)):
            words = 0
            for b in range(a, len(lines)):
                words += len(lines[b][1].split())
                if words >= least:
                    run = tuple(x for _, x in lines[a:b + 1])
                    if run in seen:
                        gone[i].update(p for p, _ in lines[a:b + 1])
            for b in range(a, len(lines)):
                seen.add(tuple(x for _, x in lines[a:b + 1]))
    out = []
    for i, (d, t) in enumerate(rows):
        if t is None:
            out.append((d, None, 0, 0))
            continue
        kept, goes = [], False
        for p, x in enumerate(t.split("\n")):
            if x.split():
                goes = p in gone[i]
            if not goes:
                kept.append(x)
        n = t.count("\n") + 1
        out.append((d, "\n".join(kept), n, n - len(kept)))
    return sorted(out, key=repr)


def run(frame, least):
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_deleted) for r in ld.dedup_lines(frame, least).collect()), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_matches_brute_force(spark, docs, seed):
    rng = np.random.default_rng(seed)
    pool = [" ".join(f"w{rng.integers(0, 60)}" for _ in range(rng.integers(1, 9))) for _ in range(25)] + ["", "  "]
    passages = [[pool[rng.integers(0, 25)] for _ in range(rng.integers(2, 7))] for _ in range(6)]
    rows = []
    for i in rng.permutation(60).tolist():
        lines = []
        for _ in range(rng.integers(1, 6)):
            lines += passages[rng.integers(0, 6)] if rng.random() < 0.5 else [pool[rng.integers(0, 27)] for _ in range(rng.integers(1, 5))]
        rows.append((i, "\n".join(lines)))
    assert run(docs(rows), 10) == brute(rows, 10)


def test_passage_of_one_line_and_exact_copy(spark, docs):
    passage = " ".join(f"p{i}" for i in range(55))
    short = "common short line"
    rows = [(1, f"{short}\nalpha\n{passage}\nomega"), (2, f"{short}\nbeta\n{passage}"), (3, f"{passage}\n\n{short}"), (4, f"{short}\nalpha\n{passage}\nomega")]
    got = {r.doc_id: (r.text, r.n_deleted) for r in ld.dedup_lines(docs(rows)).collect()}
    assert got == {1: (rows[0][1], 0), 2: (f"{short}\nbeta", 1), 3: (short, 2), 4: ("", 4)}


def test_repeat_inside_a_document(spark, docs):
    line = " ".join(f"p{i}" for i in range(60))
    assert run(docs([(1, f"{line}\nx\n{line}")]), 50) == [(1, f"{line}\nx", 3, 1)]


def test_defined_results(spark, docs):
    line = " ".join(f"p{i}" for i in range(60))
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, line), (4, line), (None, line), (5, line + "\n" + "y " * 30000)]
    got = run(docs(rows), 50)
    assert len(got) == 7
    by = {(d, t is None): (t, n, m) for d, t, n, m in got}
    assert by[1, True] == (None, 0, 0) and by[2, False] == ("", 1, 0) and by[3, False] == ("\n\n", 3, 0)
    assert by[None, False] == (line, 1, 0)  # the null id comes first
    assert [g for g in got if g[0] == 4] == [(4, "", 1, 1)] * 2
    assert by[5, False] == ("y " * 30000, 2, 1)
    assert ld.dedup_lines(docs([])).count() == 0


def test_columns_are_kept_and_clashing_ones_replaced(spark, docs):
    frame = docs([(1, "a b"), (2, "a b")]).selectExpr("*", "'x' AS n_lines", "5 AS pos")
    got = ld.clean_lines(frame)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_lines", "pos", "n_deleted"]
    assert [tuple(r) for r in got.select("n_lines", "pos", "n_deleted").collect()] == [(1, 5, 0)] * 2


def test_winnowing_keeps_few_grams_and_one_for_every_repeat(spark, docs):
    rng = np.random.default_rng(4)
    lines = [" ".join(f"w{rng.integers(0, 10**6)}" for _ in range(5)) for _ in range(400)]
    frame = docs([(1, "\n".join(lines)), (2, "\n".join(["x y"] + lines[100:112] + ["z"]))])
    got = ld.fingerprints(ld.line_table(frame), 50)
    chosen = got.where("chosen")
    assert chosen.where("id = 1").count() < 200
    assert chosen.groupBy("gram").count().where("count > 1").count() >= 1


def test_no_python_on_the_main_path(spark, docs):
    plan = ld.dedup_lines(docs([(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_small_tables_are_joined_as_large_ones_are(spark, docs, monkeypatch):
    plans, staged = [], ld.staged
    monkeypatch.setattr(ld, "staged", lambda df, name: plans.append(df._jdf.queryExecution().sparkPlan().toString()) or staged(df, name))
    plans.append(ld.dedup_lines(docs([(1, "a b c\nd e f"), (2, "a b c\nd e f")]), 4)._jdf.queryExecution().sparkPlan().toString())
    assert sum(p.count("SortMergeJoin") for p in plans) >= 4 and "BroadcastHashJoin" not in "".join(plans)
