import random

import numpy as np
import pytest
from fixtures import documents, rows_of, texts

from fragloom.llm import near_copies, stages


def plain_set(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def plain_kept(rows):
    """Ids that stay, by comparing all texts with all."""
    sets = [plain_set(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or 5 * len(a & b) >= 4 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted(least.values())


def altered(rng, words, times):
    words = list(words)
    for _ in range(times):
        at = rng.randrange(len(words))
        words[at : at + 1] = rng.choice([[], [f"x{rng.random()}"], [words[at], f"y{rng.random()}"]])
    return words


def near_copy_rows(seed):
    rng = random.Random(seed)
    line = [f"common{i}" for i in range(12)]
    rows = []
    for _ in range(12):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([4, 6, 30, 120, 600]))] + line
        chain = words
        for _ in range(9):
            rows.append(" ".join(altered(rng, words, rng.randint(0, 1 + len(words) // 30))))
            chain = altered(rng, chain, max(1, len(chain) // 80))
            rows.append(" ".join(chain))
    rows += ["", "  ", "one two", "ONE Two", " ".join(line)]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("slots, pairs", [(1 << 20, 4), (1 << 14, 0)])
def test_stage_against_comparing_all_with_all(spark, monkeypatch, slots, pairs):
    monkeypatch.setattr(near_copies, "SLOTS", slots)
    monkeypatch.setattr(near_copies, "PAIRS", pairs)
    monkeypatch.setattr(near_copies, "PAIRS_A_COPY", 1 + pairs)
    rows = near_copy_rows(slots)
    kept = stages.drop_near_duplicates(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), "")
    want = plain_kept(rows)
    assert len(want) < 2 * len(rows) // 3
    assert sorted(r.doc_id for r in kept.collect()) == want


def letters(n, words=121, own=17):
    """Texts of one form that are alike to 0.7 only: their own words stand together."""
    form = [f"form{i}" for i in range(words - own)]
    return [(i, " ".join(form[:50] + [f"own{i}x{j}" for j in range(own)] + form[50:])) for i in range(n)]


@pytest.mark.parametrize("slots", [1 << 20, 1 << 4])
def test_letters_of_one_form_make_no_crowd_of_pairs(spark, monkeypatch, slots):
    monkeypatch.setattr(near_copies, "SLOTS", slots)
    monkeypatch.setattr(near_copies, "_PART", min(slots, 1 << 14))
    compared = []
    alike = near_copies._alike

    def counted(pairs, sets):
        compared.append(pairs.count())
        return alike(pairs, sets)

    monkeypatch.setattr(near_copies, "_alike", counted)
    rows = letters(250)
    rows.append((900, rows[7][1].replace("form3 ", "other ")))  # alike to 7
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = near_copies.keep_one_of_alike(docs)
    assert sorted(r.doc_id for r in kept.collect()) == list(range(250))
    assert sum(compared) <= 4 * len(rows)


def test_given_documents_that_differ_in_more_than_two_bits(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = plain_kept([tuple(r) for r in docs.select("doc_id", "text").collect()])
    kept = stages.drop_near_duplicates(spark, docs, "")
    assert kept.schema == docs.schema
    assert [r.doc_id for r in kept.orderBy("doc_id").collect()] == want


def test_awkward_and_no_documents(spark):
    docs = documents(spark)
    kept = near_copies.keep_one_of_alike(docs)
    assert kept.columns == docs.columns
    assert rows_of(kept.subtract(docs)) == [] and 0 < kept.count() < len(texts())
    assert near_copies.keep_one_of_alike(documents(spark, [])).collect() == []


def test_simhash_tables_find_links_before_the_index(spark, monkeypatch):
    rng = random.Random(3)
    rows = []
    for i in range(30):
        words = [f"w{i}x{rng.randrange(3000)}" for _ in range(1500)]
        rows += [(10 * i + k, " ".join([*words[:700], f"z{k}", *words[700:]])) for k in range(3)]
        rows.append((10 * i + 3, " ".join(words[:1300])))  # alike to less than two bits tell
    links = []
    found = near_copies.simhash_links

    def kept_links(nodes, named, reps):
        fresh = found(nodes, named, reps)
        links.append(fresh.distinct().count())
        return fresh

    monkeypatch.setattr(near_copies, "simhash_links", kept_links)
    kept = stages.drop_near_duplicates(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), "")
    assert sorted(r.doc_id for r in kept.collect()) == plain_kept(rows) == [10 * i for i in range(30)]
    assert links[0] >= 20


def compared_pairs(monkeypatch):
    """The numbers of pairs whose complete sets are compared, as they come."""
    compared = []
    alike = near_copies._alike

    def counted(pairs, sets):
        compared.append(pairs.count())
        return alike(pairs, sets)

    monkeypatch.setattr(near_copies, "_alike", counted)
    return compared


def test_sets_of_pairs_that_are_far_from_alike_are_not_brought_together(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "SLOTS", 1 << 4)
    monkeypatch.setattr(near_copies, "_PART", 1 << 4)
    compared = compared_pairs(monkeypatch)
    rows = []
    for i in range(40):
        both = [f"w{i}x{j}" for j in range(300)]
        rows += [(2 * i + k, " ".join(both + [f"o{i}x{j}x{k}" for j in range(150)])) for k in range(2)]
    kept = near_copies.keep_one_of_alike(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert kept.count() == len(rows) and sum(compared) == 0


@pytest.mark.parametrize("size", [1, 2, 9, 90, 450, 5000])
def test_marks_lose_no_pair_that_is_alike(spark, size):
    rng = np.random.default_rng(size)
    nodes, pairs = [], []
    for i in range(60):
        a = rng.integers(0, 1 << 64, size, np.uint64, endpoint=False)
        # As unlike as pairs may be, by leaving some out or by other ones.
        gone = size // 5 if i % 2 else size // 9
        b = a[gone:] if i % 2 else np.concatenate([a[gone:], rng.integers(0, 1 << 64, gone, np.uint64, endpoint=False)])
        for node, some in ((2 * i, a), (2 * i + 1, b)):
            nodes.append((node, len(some), near_copies.mark_of(some).tolist()))
        pairs.append((2 * i, 2 * i + 1))
    marks = spark.createDataFrame(nodes, "node bigint, size bigint, mark array<bigint>")
    left = near_copies.may_be_alike(spark.createDataFrame(pairs, "u bigint, v bigint"), marks)
    assert sorted(map(tuple, left.collect())) == pairs


def test_candidates_of_a_crowd_are_the_pairs_that_pass_and_rounds_meet_some_of_each_key(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 64, 200, np.uint64, endpoint=False)
    sets = {i: np.concatenate([base[rng.random(200) > 0.04], rng.integers(0, 1 << 64, 3 + i % 18, np.uint64)]) for i in range(40)}
    marks = spark.createDataFrame([(i, near_copies.mark_of(s).tolist()) for i, s in sets.items()], "node bigint, mark array<bigint>")
    rows = [(key, i, len(s), 5, i // 2) for i, s in sets.items() for key in (1, 2)]
    live = spark.createDataFrame(rows, "key bigint, node bigint, size bigint, place bigint, root bigint")
    want = set()
    for i, a in sets.items():
        for j, b in sets.items():
            odd = sum((int(x) ^ int(y)).bit_count() for x, y in zip(near_copies.mark_of(a).view(np.uint64), near_copies.mark_of(b).view(np.uint64), strict=True))
            if i // 2 < j // 2 and 9 * odd <= len(a) + len(b) and 4 * max(len(a), len(b)) <= 5 * min(len(a), len(b)):
                want.add((i, j))
    got = near_copies.candidates(live, marks, None).collect()
    assert 0 < len(got) == len({tuple(sorted(r)) for r in got}) < 40 * 39 // 2
    assert {tuple(sorted(r)) for r in got} == want
    some = {tuple(sorted(r)) for r in near_copies.candidates(live, marks, 0).collect()}
    other = {tuple(sorted(r)) for r in near_copies.candidates(live, marks, 1).collect()}
    assert some <= want and other <= want and some != other
    assert len({v for _, v in near_copies.candidates(live, marks, 0).collect()}) <= near_copies.HUBS
