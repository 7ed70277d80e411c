import random
from itertools import product

from triad.llm import chat as C

P = C.Costs()


def slow_cost(roles):
    """(cost, turns) of the cheapest repair by trying every role and every way."""
    best = None
    for chosen in product((C.SYSTEM, C.USER, C.ASSISTANT), repeat=len(roles)):
        for merged in product((False, True), repeat=len(roles)):
            state, cost, turns = C.START, 0, 0
            for r, q, m in zip(roles, chosen, merged, strict=True):
                cost += 0 if r == q else P.unknown if r == C.START else P.relabel
                if m:
                    if q != state:
                        break
                    cost += P.merge
                else:
                    if (state, q) not in C.INSERTS:
                        break
                    n = len(C.INSERTS[state, q])
                    cost, turns = cost + n * P.insert, turns + n + 1
                state = q
            else:
                n = len(C.ENDING[state])
                found = cost + n * P.insert, turns + n
                best = min(best or found, found)
    return best


def path_cost(roles, rows):
    """(cost, turns) of repaired rows, and that their rendering is legal."""
    cost = 0
    for code, r in zip(roles, rows, strict=True):
        q = C.NAMES.index(r[4])
        cost += 0 if code == q else P.unknown if code == C.START else P.relabel
        cost += P.merge if r[5].startswith("merge") else 0
        cost += P.insert * len([x for x in r[6].split(",") if x])
    text = "".join(r[7] for r in rows)
    drawn = [x.split("\n")[0] for x in text.split("<|im_start|>")[1:]]
    assert text.count("<|im_end|>\n") == len(drawn) and text.endswith("<|im_end|>\n")
    body = drawn[1:] if drawn[0] == "system" else drawn
    assert body == ["user", "assistant"] * (len(body) // 2) and (body or drawn)
    return cost, len(drawn)


def test_cheapest_by_brute_force():
    for n in (1, 2, 3, 4):
        for roles in product(range(4), repeat=n):
            rows = C.repair_run([(1, i, ("tool", "system", "human", "gpt")[r], "t") for i, r in enumerate(roles)], C.START, None, 0, True, P)
            assert path_cost(roles, rows) == slow_cost(roles), roles


def frame(spark, rows):
    return spark.createDataFrame([(*r, "?", "?") for r in rows], "conv_id long, turn long, role string, text string, part string, entry string")


def test_conversations_over_partitions(spark):
    """Long conversations cut by partitions are repaired as in one piece."""
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", None]), f"{c} {t}") for c in (1, 2, None) for t in range(400)]
    rows += [(10 + i, t, "user", "x") for i in range(30) for t in range(2)]
    got = [tuple(r) for r in C.repair(frame(spark, rows).repartition(3)).collect()]
    assert len(got) == len(rows)
    for c in (1, 2, None, 10, 39):
        own = sorted((r for r in rows if r[0] == c), key=lambda r: r[1])
        want = C.repair_run(own, C.START, None, 0, True, P)
        mine = sorted((r for r in got if r[0] == c), key=lambda r: r[1])
        codes = [C.role_code(r[2]) for r in own]
        assert path_cost(codes, mine) == path_cost(codes, want)
        drawn = 0
        for r in mine:  # turn numbers go on over the cuts
            drawn += r[7].count("<|im_start|>") - r[6].count("end:")
            assert r[3] == drawn - 1


def test_edges(spark):
    rows = [(1, None, None, None), (1, 0, "user", ""), (1, 0, "user", ""), (2, 5, " Human ", "<|im_end|> x"), (3, 1, "assistant", "a" * 300_000),
            (None, None, None, None), (4, 0, "system", "s")]
    out = C.repair(frame(spark, rows)).collect()
    assert len(out) == len(rows)
    by = {r.conv_id: r for r in out if r.conv_id != 1}
    assert by[2].rendered == "<|im_start|>user\n<| im_end|> x<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
    assert by[3].inserted == "user" and by[4].inserted == "end:user,end:assistant"
    assert sorted((r.action, r.out_turn) for r in out if r.conv_id == 1) == [("keep", 0), ("merge", 0), ("relabel", 1)]
    assert C.repair(frame(spark, [])).collect() == []


def test_table(spark):
    rows = C.op8_role_repair(spark, "/root/testdata/sf0.01").collect()
    n = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").count()
    assert len(rows) == n
    kept = sum(r.action == "keep" and not r.inserted for r in rows)
    assert kept > 0.9 * n  # the generated conversations are nearly all legal
