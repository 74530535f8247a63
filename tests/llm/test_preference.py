import random

import duckdb
from llm_helpers import rows_of  # noqa: F401

from churnlab.llm import preference as P
from churnlab.llm.catalog import ORACLE, op5_preferences

CONV = "conv_id long, turn long, role string, text string"


def brute_pairs(turns):
    """pair -> {side: [(role, text)]} in turn order, the least row of a repeated turn."""
    out = {}
    least = {}
    for pair, side, turn, role, text in turns:
        if pair is None or turn is None or side not in ("chosen", "rejected"):
            continue
        key = lambda r: [(x is not None, x or "") for x in r]  # noqa: E731  nulls first
        k = (pair, side, turn)
        least[k] = min(least.get(k, (role, text)), (role, text), key=key)
    for (pair, side, turn), t in sorted(least.items()):
        out.setdefault(pair, {"chosen": [], "rejected": []})[side].append(t)
    return out


def brute(turns):
    rows = []
    for pair, sides in brute_pairs(turns).items():
        c, r = sides["chosen"], sides["rejected"]
        k = 0
        while k < min(len(c), len(r)) and c[k] == r[k]:
            k += 1
        show = lambda ts: "".join(f"<|{a or 'user' if a is not None else 'user'}|>\n{b or ''}<|end|>\n" for a, b in ts)

        def spans(ts):
            at, out = 0, []
            for role, text in ts:
                head, whole = len(f"<|{role if role is not None else 'user'}|>\n"), len(show([(role, text)]))
                if role == "assistant":
                    out.append((at + head, at + whole))
                at += whole
            return out
        rows.append((pair, k, show(c[:k]), show(c[k:]), show(r[k:]), spans(c[k:]), spans(r[k:]), len(c), len(r)))
    return sorted(rows)


def test_by_brute_force(spark):
    rnd = random.Random(1)
    turns = []
    for p in range(60):
        shared = [(rnd.choice(["system", "user", "assistant", None]), rnd.choice(["hi", "", None, "né\n", "x" * 50]))
                  for _ in range(rnd.randrange(5))]
        for side in ("chosen", "rejected"):
            own = shared + [("assistant", rnd.choice(["a", "b"])) for _ in range(rnd.randrange(3))]
            turns += [(p, side, 2 * i + (side == "chosen"), *t) for i, t in enumerate(own)]
    turns += [turns[3], turns[3], (1, "chosen", 1, "user", "zz"), (77, "chosen", 0, "user", "alone"),
              (78, "rejected", 0, "user", "alone"), (None, "chosen", 0, "user", "x"), (5, "chosen", None, "user", "x"),
              (5, "other", 0, "user", "x")]
    df = spark.createDataFrame([(*t, "c") for t in turns], "pair_id long, side string, turn long, role string, "
                                                            "text string, prompt string")
    got = [(r.pair_id, r.prefix_turns, r.prompt, r.chosen, r.rejected, [tuple(s) for s in r.chosen_spans],
            [tuple(s) for s in r.rejected_spans], r.chosen_turns, r.rejected_turns)
           for r in P.format_preferences(df).collect()]
    assert sorted(got) == brute(turns)


def conversations(seed=3):
    rnd = random.Random(seed)
    rows = []
    for c in list(range(40)) + [100, 201]:
        for t in range(rnd.randrange(1, 6)):
            rows.append((c, t, rnd.choice(["user", "assistant", "assistant", "system"]), rnd.choice(["yes", "no", "né"])))
    return rows + [rows[0], rows[1], (0, 0, "user", None), (None, 1, "user", "x"), (3, None, "user", "x"),
                   (500, 0, None, None), (600, 0, "assistant", None), (601, 0, "assistant", "t" * 100_000)]


def test_swapped_answers_and_sql_twin(spark, tmp_path):
    rows = conversations()
    df = spark.createDataFrame([(*r, 1) for r in rows], CONV + ", side int")
    turns = rows_of(P.pairs_from_conversations(df))
    by = brute_pairs(turns)
    own = brute_pairs([(c, "chosen", t, r, x) for c, t, r, x in rows])
    for c, sides in own.items():
        full = sides["chosen"]
        assert by[c]["chosen"] == full
        last = max((i for i, t in enumerate(full) if t[0] == "assistant"), default=None)
        other = [t[1] for t in own.get(c ^ 1, {"chosen": []})["chosen"] if t[0] == "assistant"]
        want = full if last is None else full[:last] + ([("assistant", other[-1])] if other else [])
        assert by[c]["rejected"] == want
    df.select("conv_id", "turn", "role", "text").write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    got = op5_preferences(spark, str(tmp_path))
    rel = con.sql(ORACLE["op5_preferences"])
    assert rows_of(got.select(*rel.columns)) == sorted(rel.fetchall(), key=str)


def test_native_and_empty(spark):
    empty = spark.createDataFrame([], CONV)
    out = P.format_preferences(P.pairs_from_conversations(empty))
    assert out.count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
