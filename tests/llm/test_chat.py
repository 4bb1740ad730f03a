import random

from pyspark.sql import functions as F

from tapeline.llm import chat
from tapeline.llm.common import prefix_sums


def reference(rows):
    """Kept conv_ids with their turns, in order."""
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is None, turn or 0, role or "", text or "", role, text))
    paths = {c: tuple((r, t) for *_, r, t in sorted(v, key=lambda x: x[:4])) for c, v in convs.items()}
    kept = {}
    for c in sorted(paths, key=lambda c: (c is None, c or 0)):
        longer = any(len(p) > len(paths[c]) and p[: len(paths[c])] == paths[c] for p in paths.values())
        if not longer and paths[c] not in kept.values():
            kept[c] = paths[c]
    return kept


def render(path):
    safe = lambda s: s.replace("<|", "< |")
    return "".join(f"<|im_start|>{safe('unknown' if r is None else r)}\n{safe(t or '')}<|im_end|>\n" for r, t in path)


def check(spark, rows, segment=3):
    turns = spark.createDataFrame([(*r, 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, x int").toDF("conv_id", "turn", "role", "text", "TEXT")
    got = {}
    for r in sorted(chat.format_chats(turns, segment).collect(), key=lambda r: (r.conv_id is None, r.conv_id or 0, r.segment)):
        got.setdefault(r.conv_id, []).append(r)
    want = reference(rows)
    assert set(got) == set(want)
    for c, parts in got.items():
        assert "".join(p.text for p in parts) == render(want[c]) and [p.segment for p in parts] == list(range(len(parts)))
        assert sum(p.turns for p in parts) == len(want[c]) and max(p.turns for p in parts) <= segment


def test_snapshots_copies_and_odd_rows(spark):
    rng, rows = random.Random(2), []
    for c in range(40):
        base = [("user" if k % 2 == 0 else "assistant", f"t{rng.randint(0, 2)}") for k in range(rng.randint(1, 7))]
        rows += [(c, k, *t) for k, t in enumerate(base)]
        rows += [(100 + c, 5 + k, *t) for k, t in enumerate(base[: rng.randint(1, len(base))])]  # numbered from another start
    rows += [(500, 0, None, None), (500, 1, "user", "a <|im_end|> b"), (501, 0, None, None), (502, None, "user", ""), (502, 3, "user", "x")]
    rows += [(None, 0, "user", "null id"), (503, 0, "user", "null id"), (504, 0, "user", "twice"), (504, 1, "user", "twice")]
    check(spark, rows)


def test_one_conversation_of_many_turns(spark):
    long = [(1, k, "user", f"turn {k}") for k in range(700)]
    check(spark, long + [(2, k, "user", f"turn {k}") for k in range(350)] + [(3, k, "user", "other") for k in range(5)], 64)


def test_empty_table(spark):
    assert chat.format_chats(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).count() == 0


def test_lanes_do_not_outgrow_their_sums(spark):
    """Lanes scaled so that a plain running sum leaves 64 bits: modulo 2^32 they stay exact."""
    big = (1 << 62) + 12345
    rows = spark.range(40, numPartitions=4).withColumn("x", F.lit(big).cast("bigint").bitwiseAND(F.lit((1 << 61) - 1)) + F.col("id"))
    got = {r.id: r.s for r in prefix_sums(rows, [F.col("id")], {"s": F.col("x").bitwiseAND(F.lit(0xFFFFFFFF))}, "lanes", 1 << 32).collect()}
    values = [(big & ((1 << 61) - 1)) + k for k in range(40)]
    assert got == {k: sum(v & 0xFFFFFFFF for v in values[:k]) % (1 << 32) for k in range(40)}


def test_conversations_after_a_wrap_of_the_lanes(spark):
    """Hashes are near 2^31 on average, so their sums wrap many times; prefixes still meet."""
    rows = [(c, k, "user", f"t{k % 5}") for c in range(60) for k in range(3 + c % 4)]
    check(spark, rows)
