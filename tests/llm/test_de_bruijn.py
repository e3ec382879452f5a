import hashlib

import pytest
from fixtures import documents, prose, space_words, texts

from fragloom.llm import bitmaps, de_bruijn, repeats


def expected(rows):
    """First places of all windows, then what is covered by windows that start later."""
    order = lambda r: (r[0] is not None, r[0] or 0)
    first = {}
    for i, text in rows:
        words = space_words(text)
        for at in range(len(words) - 19):
            window = tuple(words[at : at + 20])
            place = (*order((i,)), at)
            first[window] = min(first.get(window, place), place)
    out = []
    for i, text in rows:
        words = space_words(text)
        gone = set()
        for at in range(len(words) - 19):
            if first[tuple(words[at : at + 20])] < (*order((i,)), at):
                gone.update(range(at, at + 20))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def removed(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in df.collect()), key=repr)


@pytest.mark.parametrize("bits", [1 << 27, 1 << 15])
def test_every_case_against_plain_windows(spark, monkeypatch, bits):
    monkeypatch.setattr(bitmaps, "BITS", bits)
    assert removed(de_bruijn.remove_repeats(documents(spark))) == expected(texts())


def test_branches_at_every_distance(spark):
    passage = prose(50, 45).split()
    rows = [(0, " ".join(passage))]
    rows += [(n, " ".join(prose(60 + n, 5).split() + passage[n : n + 21] + prose(90 + n, 5).split())) for n in range(1, 24)]
    assert removed(de_bruijn.remove_repeats(documents(spark, rows))) == expected(rows)


def test_no_rows(spark):
    assert de_bruijn.remove_repeats(documents(spark, [])).collect() == []


def test_nothing_repeats(spark):
    rows = [(i, prose(1000 + i, 40)) for i in range(5)]
    assert all(r.n_removed == 0 for r in de_bruijn.remove_repeats(documents(spark, rows)).collect())


def paths_of(spark, rows):
    """Occurrences (doc, start, edges) of the paths of a corpus, by their first place; and the number of runs."""
    found = de_bruijn.RepeatedRuns(de_bruijn.as_texts(documents(spark, rows), "doc_id", "text"), de_bruijn.WordText)
    out = {}
    for r in de_bruijn.path_places(found).collect():
        out.setdefault((r.first.doc, r.first.start), []).append((r.doc, r.start, r.n))
    return out, found.runs.where("times > 1").count()


def test_paths_end_where_the_graph_branches(spark):
    trunk, left, right = (" ".join(f"{name}{i}" for i in range(150)) for name in ("t", "l", "r"))
    ends = {1: left, 2: left, 3: right, 4: right}
    rows = [(i, f"{prose(600 + i, 30)} {trunk} {end} {prose(700 + i, 30)}") for i, end in ends.items()]
    paths, runs = paths_of(spark, rows)
    # The trunk, and what follows it from the branching node on, each as one path.
    assert sorted(len(places) for places in paths.values()) == [2, 2, 4] and runs > 20
    words = {i: space_words(text) for i, text in rows}
    for (doc, start), places in paths.items():
        edges = {n for _, _, n in places}
        assert len(edges) == 1 and (doc, start) == min((d, s) for d, s, _ in places)
        size = edges.pop() + 19
        assert size > 120 and len({tuple(words[d][s : s + size]) for d, s, _ in places}) == 1


def test_a_chain_of_many_runs_is_one_path_and_rings_end(spark):
    long = " ".join(f"w{i}" for i in range(3000))
    paths, runs = paths_of(spark, [(1, long), (2, f"before {long}"), (3, "ab " * 500), (4, "x y " * 300)])
    chains = [places for first, places in paths.items() if first[0] == 1]
    assert len(chains) == 1 and len(chains[0]) == 2 and chains[0][0][2] > 2900 and runs > 100


def test_equal_hashes_of_runs_that_follow_do_not_join_others(spark, monkeypatch):
    # All anchors of a text collide: every window has the same one, so runs are told apart by content alone.
    hashes = de_bruijn.WordText.runs

    def collided(self):
        found = hashes(self)
        found.anchors[:] = 1
        return found

    monkeypatch.setattr(de_bruijn.WordText, "runs", collided)
    rows = texts()[:28]
    assert removed(de_bruijn.remove_repeats(documents(spark, rows))) == expected(rows)


def test_degrees_are_hash_aggregates_and_anchors_come_alone(spark, monkeypatch):
    plans, scans = {}, []
    stored, scan = de_bruijn.stored, repeats.scan

    def seen(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return stored(df, label)

    def scanned(*args, **options):
        scans.append(scan(*args, **options))
        return scans[-1]

    monkeypatch.setattr(de_bruijn, "stored", seen)
    monkeypatch.setattr(repeats, "scan", scanned)
    long = " ".join(f"w{i}" for i in range(200))
    rows = [(1, long), (2, f"before {long}")]
    assert removed(de_bruijn.remove_repeats(documents(spark, rows))) == expected(rows)
    assert "HashAggregate" in plans["run-degrees"] and "SortAggregate" not in plans["run-degrees"]
    assert scans[0].columns == ["anchor"]
    # Edges are only shuffled if they may occur again.
    assert "repeated-edges" in plans


@pytest.mark.parametrize("at_once", [1 << 15, 3])
def test_words_are_hashed_together_as_split_finds_them(monkeypatch, at_once):
    monkeypatch.setattr(repeats, "_WORDS_AT_ONCE", at_once)
    odd = ["", " ", "\t a\x0bb\x0c\r\n", "a\0 a \0a \xa0 \x1c \u2003x ab ba a", " ".join("x" * n for n in (63, 64, 65, 66, 200, 64)) + " "]
    odd += ["y" * 64 + "a " + "y" * 64 + "b " + "y" * 64]
    word_of = {}
    for text in [t or "" for _, t in texts()] + odd:
        words, hashes = text.encode().split(), repeats.word_hashes(text.encode()).tolist()
        assert len(words) == len(hashes)
        for word, found in zip(words, hashes, strict=True):
            assert word_of.setdefault(found, word) == word
    assert len(set(word_of.values())) == len(word_of) > 4000
