import random

import duckdb

from martlib.llm import preferences

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    sides = {}
    key = lambda t: tuple((x is not None, x if x is not None else 0) for x in t)
    for conv, *turn in rows:
        if conv is not None:
            sides.setdefault(conv // 2, {0: [], 1: []})[conv % 2].append(tuple(turn))
    out = {}
    for pair, side in sides.items():
        c, r = ([t[1:] for t in sorted(side[k], key=key)] for k in (0, 1))
        n = 0
        while n < min(len(c), len(r)) and c[n] == r[n]:
            n += 1
        render = lambda turns: "".join(f"<|{a or ''}|>\n{b or ''}<|end|>\n" for a, b in turns)

        def mask(turns, render=render):
            at, spans = 0, []
            for a, b in turns:
                size = len(render([(a, b)]))
                if a == "assistant":
                    spans.append(f"{at + len(f'<|{a}|>') + 1}:{at + size}")
                at += size
            return ",".join(spans)

        out[pair] = (n, render(c[:n]), render(c[n:]), render(r[n:]), mask(c[n:]), mask(r[n:]))
    return out


def test_equals_plain_and_sql(spark):
    rng = random.Random(2)
    rows = []
    for conv in range(60):
        for turn in range(rng.randint(0, 5)):
            rows.append((conv, turn, rng.choice(["user", "assistant", None]), rng.choice(["é😀", "", None, "b"])) if rng.random() < 0.5 else (conv, turn, "user" if turn % 2 == 0 else "assistant", "same"))
    rows += [(None, 0, "user", "x"), (70, None, "user", "n"), (70, 1, "user", "n"), (70, 1, "user", "n"), (71, None, "user", "n"), (71, 1, "user", "n"), (71, 1, "user", "n"), (71, 2, "assistant", "a" * 50_000)]
    got = preferences.preference_pairs(preferences.neighbours(spark.createDataFrame(rows, SCHEMA))).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == plain(rows)
    db = duckdb.connect()
    db.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    db.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    assert {r[0]: r[1:] for r in db.execute(preferences.SQL).fetchall()} == plain(rows)


def test_given_table_and_columns(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    got = preferences.preference_pairs(preferences.neighbours(df))
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == plain([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
    more = preferences.neighbours(df).withColumn("first", df["text"]).withColumn("place", df["turn"]).withColumn("c", df["role"])
    assert preferences.preference_pairs(more).count() == got.count()
    assert preferences.preference_pairs(preferences.neighbours(df.limit(0))).count() == 0
