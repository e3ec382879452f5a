"""Tries against plain dictionaries of prefixes, with shards of any size."""

import hashlib
import random
import zlib

import pytest
from fixtures import rows_of, space_words, write_tables

from fragloom.llm import prefix_trie
from fragloom.llm.prefix_trie import op13_prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, words string, node string, shard bigint, turns string"


def plain_series(rows):
    """Turns (role, text) by conversation. Rows of one turn number must be alike here."""
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0)):
        if conv is not None:
            out.setdefault(conv, []).append((role or "", text or ""))
    return out


def plain_branched(series):
    out = {}
    for c in series:
        h = zlib.crc32(str(c).encode()) % 4
        family = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        out[c] = series.get(family, [])[:h] + series[c][h:]
    return out


def plain_trie(series):
    members, ends = {}, {}
    for c, turns in series.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    sums = {}
    for node in sorted(members, key=len, reverse=True):
        saved = (len(members[node]) - 1) * len(space_words(node[-1][1])) if node else 0
        leaves = 0 if node in children else 1
        for child in children.get(node, []):
            saved, leaves = saved + sums[child][0], leaves + sums[child][1]
        sums[node] = saved, leaves
    out = []
    for node, of in members.items():
        digest = hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        saved, leaves = sums[node]
        out.append((min(of), len(node), parent, len(of), len(children.get(node, [])), leaves, saved, digest))
    return sorted(out, key=repr)


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "w", "n", 1, "t") for r in rows], SCHEMA).repartition(5)


def talk(seed, convs=160, kinds=6, longest=9):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        conv = c * rng.choice([1, 1, 3])
        if any(r[0] == conv for r in rows):
            continue
        for turn in range(rng.randint(1, longest)):
            rows.append((conv, turn, ["user", "assistant", None][turn % 2], f"say {rng.randrange(kinds)} " * rng.randint(1, 2)))
    return rows


def awkward():
    rows = talk(3)
    rows += [(400 + i, t, "user", f"hot {t}") for i in range(90) for t in range(4)]  # one series of a third of all
    rows += [(600 + i, 0, "user", "a first turn that many share") for i in range(40)]
    rows += [(600 + i, 1, "assistant", f"reply {i % 9}") for i in range(40)]
    rows += [(2000, t, "user", f"long {t % 3}") for t in range(150)]
    rows += [(2001, t, "user", f"long {t % 3}" if t < 100 else "off") for t in range(130)]
    rows += [(2002, t, "user", f"long {t % 3}") for t in range(64)]
    rows += [(2003, t, "user", f"long {t % 3}") for t in range(32)]
    rows += [(None, 0, "user", "of no conversation"), (3000, None, None, None), (3000, 5, "user", ""), (-7, 1, "user", "x"), (-41, 0, "user", "y")]
    rows += [(3020, None, "user", "null first"), (3020, -4, "user", "then this"), (3021, 1, "ab", "c"), (3022, 1, "a", "bc")]
    return rows + rows[:5]  # repeated rows


@pytest.mark.parametrize("turns, panel", [(1 << 20, 32), (60, 32), (7, 2), (400, 1)])
def test_against_plain_prefixes(spark, tmp_path, monkeypatch, turns, panel):
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", turns)
    monkeypatch.setattr(prefix_trie, "PANEL", panel)
    rows = awkward()
    folder = write_tables(spark, str(tmp_path), conversations=conversations(spark, rows))
    assert rows_of(op13_prefix_trie(spark, folder)) == plain_trie(plain_branched(plain_series(rows)))


@pytest.mark.parametrize("seed", range(3))
def test_plain_series_without_branches(spark, monkeypatch, seed):
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", 40)
    rows = talk(seed, convs=120, kinds=2, longest=5)
    got = prefix_trie.trie(prefix_trie.series(conversations(spark, rows)), len(rows))
    assert rows_of(got) == plain_trie(plain_series(rows))


def test_no_rows_and_only_null_ids(spark):
    for rows in ([], [(None, 1, "user", "x")]):
        assert prefix_trie.trie(prefix_trie.series(conversations(spark, rows)), len(rows)).collect() == []


def test_families_are_joined_by_one_exchange(spark):
    from pyspark.sql import functions as F

    made = prefix_trie.branched(prefix_trie.series(conversations(spark, talk(1))), F.col("conv_id") % 20, F.lit(1), 3)
    assert "CartesianProduct" not in made._jdf.queryExecution().toString()
