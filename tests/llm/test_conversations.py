import hashlib
import random
import zlib
from itertools import groupby

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.llm import conversations

ROWS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
    T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
])
SPACE = " \t\n\x0b\x0c\r"


def damage(rows):
    out = []
    for c, t, role, text in rows:
        name = f"{' ' if c is None else c}:{' ' if t is None else t}"
        hit = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if hit == 1:
            text = ""
        if hit == 2:
            text = "".join(x for x in text if x not in ".!?")
        if hit == 4:
            role = "user"
        out += [(c, t, role, text)] * {0: 0, 3: 2}.get(hit, 1)
    return out


def least_edits(rows):
    """All cheapest edits by search over (row, output so far), without states: least (cost, letters, output)."""
    accepted = lambda out: out == "" or (len(out.lstrip("s")) % 2 == 0 and out.lstrip("s") != "")
    best, todo = None, [(0, "", 0, "", ())]
    bound = 4 * len(rows)
    while todo:
        cost, letters, i, shape, lines = todo.pop()
        if cost > bound:
            continue
        if i == len(rows) and accepted(shape):
            if best is None or (cost, letters) < best[:2]:
                best, bound = (cost, letters, lines), min(bound, cost)
        turn = "a" if shape.endswith("u") else "u"
        name = {"u": "user", "a": "assistant"}[turn]
        if not letters.endswith("III"):
            todo.append((cost + 3, letters + "I", i, shape + turn, (*lines, f"{name}:")))
        if i < len(rows):
            role, text, fault = rows[i]
            if fault not in ("blank", "duplicate"):
                late = 3 * (fault == "truncated")
                todo.append((cost + 3 + late, letters + "R", i + 1, shape + turn, (*lines, f"{name}:{text}")))
                if role[:1] == turn or (role[:1] == "s" and not shape):
                    todo.append((cost + late, letters + "K", i + 1, shape + role[:1], (*lines, f"{role}:{text}")))
            todo.append((cost + 4, letters + "D", i + 1, shape, lines))
    return best


def brute(rows):
    out, left = {}, damage(rows)
    for c in {r[0] for r in rows}:
        mine = [r for r in left if r[0] == c]
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.md5(f"{len(r[2])}:{r[2]}:{r[3]}".encode()).digest()))
        seen, faults = set(), []
        for _, _, role, text in mine:
            bare = text.rstrip(SPACE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append((role, text, fault))
        turns = {r[1] for r in mine if r[1] is not None}
        cost, letters, lines = least_edits(faults)
        count = [sum(f == k for _, _, f in faults) for k in ("blank", "duplicate", "truncated")]
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[c] = (gaps, *count, illegal, cost, letters, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def check(spark, rows):
    df = spark.createDataFrame(rows, ROWS).repartition(3)
    extra = df.withColumns({n: F.lit("x") for n in ("copies", "digest", "block", "hit", "first", "rows", "cost", "mark")})
    got = conversations.damage_repairs(extra).collect()
    found = {r.conv_id: tuple(r)[1:] for r in got}
    assert len(found) == len(got)
    assert found == brute(rows)
    return found


def talk(rng, c, n):
    texts = ["Yes.", "No?", "Go on", "", " \t", None, "So it is!\n", "é. "]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, "", "sys", "u"]
    return [(c, rng.choice([k, k, k + 1, None]), rng.choice(roles), rng.choice([*texts, f"Text {k}.", f"Text {k}"])) for k in range(n)]


def test_random_conversations(spark):
    rng = random.Random(3)
    rows = [r for c in range(60) for r in talk(rng, c, rng.randint(1, 7))] + talk(rng, None, 4)
    check(spark, rows)


@pytest.mark.parametrize("size", [1, 2, 3])
def test_small_blocks_give_the_same(spark, size):
    rng = random.Random(size)
    rows = [r for c in range(30) for r in talk(rng, c, rng.randint(1, 8))]
    df = spark.createDataFrame(rows, ROWS)
    whole = {r.conv_id: tuple(r) for r in conversations.damage_repairs(df).collect()}
    assert {c: v[1:] for c, v in whole.items()} == brute(rows)
    for items in blocks_of(rows):
        once = conversations.solve(items, conversations.END, [0])[0]
        assert split(items, size) == once[:2]


def blocks_of(rows):
    for _, mine in groupby(sorted(damage(rows), key=lambda r: (r[0], r[1] or 0)), key=lambda r: r[0]):
        yield [("-", 0, 0, "", "") if not t.strip() else (r[:1] if r[:1] in ("s", "u", "a") else "?", 3 * (t[-1] not in ".!?"), len(t) % 2, r, t) for _, _, r, t in mine]


def split(items, size):
    """Costs and letters through blocks: vectors backward, states forward."""
    blocks = []
    for k in range(0, len(items), size):
        block = conversations.Block()
        block.rows = items[k : k + size]
        blocks.append(conversations._opened(0, block, k))
    ends, v = [], list(conversations.END)
    for b in reversed(blocks):
        ends.insert(0, v)
        v = [min(conversations._total(b["costs"], q, r, v) for r in range(4)) for q in range(4)]
    state, letters = 0, ""
    for k, (b, end) in enumerate(zip(blocks, ends)):
        went = min(range(4), key=lambda r: (conversations._total(b["costs"], state, r, end), b["ranks"][4 * state + r]))
        _, piece, out = conversations.solve(items[k * size : (k + 1) * size], tuple(end), [state])[state]
        assert out == went
        state, letters = out, letters + piece
    return v[0], letters


def test_one_conversation_over_many_partitions(spark):
    rows = [(7, k // 3, ["user", "assistant", "system"][k % 3], f"Text {k % 4000}{'.' * (k % 5 > 0)}") for k in range(9000)]
    rows += [(c, 0, "user", "Hi.") for c in range(5)]
    got = {r.conv_id: r for r in conversations.damage_repairs(spark.createDataFrame(rows, ROWS)).collect()}
    mine = sorted((r for r in damage(rows) if r[0] == 7), key=lambda r: (r[1], r[2].encode(), hashlib.md5(f"{len(r[2])}:{r[2]}:{r[3]}".encode()).digest()))
    seen, items, lines = set(), [], []
    for _, _, role, text in mine:
        dead = not text.strip() or (role, text) in seen
        seen.add((role, text))
        items.append(("-", 0, 0, "", "") if dead else (role[0], 3 * (text[-1] != "."), 0, role, text))
    cost, letters, state = conversations.solve(items, conversations.END, [0], lines)[0]
    letters += conversations._closing(state, lines)
    r = got[7]
    assert (r.cost, r.audit, r.repaired_sha256) == (cost, letters, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    assert r.gaps == 3000 - len({m[1] for m in mine})
    assert r.illegal == sum(a[2][0] + b[2][0] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))


def test_repeated_rows_and_long_text(spark):
    check(spark, [(1, 0, "user", "Hi. " * 50_000)] + [(1, 2, "assistant", "Yes.")] * 9 + [(2, None, None, None)] * 3 + [(3, 5, "system", "Be kind.")])


def test_empty_table(spark):
    assert conversations.damage_repairs(spark.createDataFrame([], ROWS)).collect() == []
