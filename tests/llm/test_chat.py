import itertools
import random

from pyspark.sql import functions as F

from barwise.llm import chat

CONV = "conv_id long, turn long, role string, text string"


def cheapest(roles):
    """Least cost and output turns over all actions, by plain search over the automaton."""
    best = {chat.START: (0, 0)}
    for r in roles:
        new = {}
        for s, (c, n) in best.items():
            relabel = lambda q: 0 if q == r else 1 if r == 3 else 5  # noqa: E731,B023
            moves = [(relabel(q), q + 1, 1) for q in chat.LEGAL[s]]
            moves += [(1 + relabel(s - 1), s, 0)] if s else []
            moves += [(3 + relabel(q), q + 1, 2) for x in chat.LEGAL[s] for q in chat.LEGAL[x + 1]]
            for cost, to, outs in moves:
                new[to] = min(new.get(to, (10**9, 0)), (c + cost, n + outs))
        best = new
    end = {chat.START: (0, 0), chat.SYSTEM: (6, 2), chat.USER: (3, 1), chat.ASSISTANT: (0, 0)}
    return min((c + end[s][0], n + end[s][1]) for s, (c, n) in best.items())


def legal(roles):
    body = roles[1:] if roles[:1] == ["system"] else roles
    return len(body) % 2 == 0 and all(r == ("user", "assistant")[i % 2] for i, r in enumerate(body))


def results(spark, rows, parts):
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        return chat.repaired(spark.createDataFrame(rows, CONV).withColumn("pid", F.lit("x"))).orderBy("conv_id", "out_turn").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_least_cost_for_any_partitioning(spark):
    rng = random.Random(1)
    names = ["system", "user", "assistant", "User ", None, "tool"]
    rows, convs = [], {}
    for c in range(40):
        roles = [rng.choice(names) for _ in range(rng.randint(1, 9))]
        convs[c] = roles
        rows += [(c, i, r, rng.choice([None, "", f"t{c}.{i}"])) for i, r in enumerate(roles)]
    hot = [rng.choice(names) for _ in range(400)]  # one conversation over most partitions
    convs[99] = hot
    rows += [(99, i, r, f"h{i}") for i, r in enumerate(hot)]
    rng.shuffle(rows)
    one, many = results(spark, rows, 1), results(spark, rows, 13)
    assert one == many
    for c, roles in convs.items():
        out = [r for r in one if r.conv_id == c]
        assert [r.out_turn for r in out] == list(range(len(out))) and legal([r.role for r in out])
        assert (sum(r.cost for r in out), len(out)) == cheapest([chat._role(r) for r in roles])
        assert sum(r.n_source for r in out) == len(roles)
        texts = [t for _, _, _, t in sorted((x for x in rows if x[0] == c), key=lambda x: x[1])]
        joined = "".join(r.rendered.split("\n", 1)[1].removesuffix("<|end|>\n") for r in out)
        assert joined.replace("\n", "") == "".join(t or "" for t in texts)


def test_all_short_conversations_are_optimal():
    for n in range(1, 5):
        for roles in itertools.product(range(4), repeat=n):
            chosen, last = chat.repair(list(roles), chat.START, chat.END)
            cost = sum(o[0] for o in chosen) + chat.END[last]
            assert (cost // chat._UNIT, cost % chat._UNIT) == cheapest(roles)


def test_edges(spark):
    assert results(spark, [], 3) == []
    got = results(spark, [(None, None, None, None), (7, 1, "user", "a"), (7, 1, "user", "a")], 3)
    assert [(r.conv_id, r.role, r.n_source) for r in got] == [(None, "user", 1), (None, "assistant", 0), (7, "user", 2), (7, "assistant", 0)]
    assert got[2].rendered == "<|user|>\na\na<|end|>\n"
