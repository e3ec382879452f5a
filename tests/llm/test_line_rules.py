"""Figures, base rules and line rules against plain Python."""

import random
import re

import pytest
from fixtures import documents, prose, rows_of, space_words, texts

from fragloom.llm import line_rules
from fragloom.llm.line_rules import PHRASES


def plain_line(line):
    words = space_words(line)
    n = len(words)
    return (
        n >= 3
        and re.search(r"""[.!?…。！？]["'”’»)\]]*([ \t-\r]|$)""", line) is not None
        and 2 * sum(c in "#*$%&|<>" for c in line) < n
        and 3 * sum(w.endswith("!") for w in words) <= n
        and 5 * sum(w.startswith(("|", "/", "•", "·", "»", "›", ">", "::")) for w in words) < n
        and not any(p in line.lower() for p in PHRASES)
    )


def plain(doc_id, text):
    text = text or ""
    words = space_words(text)
    places, covered = {}, set()
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i : i + 8]), []).append(i)
    for at in places.values():
        if len(at) > 1:
            covered.update(j for i in at for j in range(i, i + 8))
    lines = [line for line in text.split("\n") if space_words(line)]
    left = [line for line in lines if plain_line(line)]
    chars, kept_chars = (sum(len(w) for line in some for w in space_words(line)) for some in (lines, left))
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    figures = len(words), chars, sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)
    kept = not failed and 100 * (chars - kept_chars) <= 30 * chars
    return doc_id, *figures, failed, len(lines) - len(left), kept_chars, "\n".join(left), kept


def awkward():
    rng = random.Random(1)
    menu = "Home | About | Contact | Search"
    good = "This is a line of prose that ends well."
    lines = [good, "and one of prose that does not", menu, "Accept cookies to read on, please.", "», she said.", "OK.", "Buy! Now! Cheap!", ""]
    rows = [(1000 + i, "\n".join(rng.choices(lines + [prose(i, 12)] * 6, k=rng.randint(1, 30)))) for i in range(120)]
    words = [f"w{i}" for i in range(30)]
    rows += [
        (2000, " ".join(words + words[:7]) + "."),  # no window twice
        (2001, " ".join(words + words[:8]) + "."),
        (2002, " ".join(words[:8] * 3)),
        (2003, "a " * 500),
        (2004, "x\r\ny\r\nx\r\n z z \x1c q\x85"),
        (2005, "\n".join([good] * 40)),
        (2006, "\n".join([f"{i} {good}" for i in range(40)])),
        (2007, " \n\t\n"),
        (2008, " ".join(f"{prose(i, 9)} | » ›" for i in range(400))),
        (2009, "x."),
    ]
    return rows


def test_figures_and_verdicts_against_plain_rules(spark):
    rows = texts() + awkward()
    got = line_rules.judge_documents(documents(spark, rows))
    want = [plain(*row) for row in rows]
    assert rows_of(got) == sorted(want, key=repr)
    assert {r[-1] for r in want} == {True, False} and any(0 < r[7] and r[-1] for r in want)


def test_kept_texts_lose_their_failing_lines(spark):
    text = "\n".join([prose(i, 40).replace("\n", " ") + "." for i in range(3)] + ["Home | About | Terms"])
    docs = spark.createDataFrame([(1, text), (2, "Home | About | Terms")], "doc_id bigint, text string")
    assert [tuple(r) for r in line_rules.keep_clean(docs).collect()] == [(1, text.rsplit("\n", 1)[0])]


def test_no_documents(spark):
    assert line_rules.judge_documents(documents(spark, [])).collect() == []


@pytest.mark.parametrize("forbidden", ["Python", "Arrow", "Pandas", "Exchange"])
def test_plan_has_no_python_and_no_shuffle(spark, forbidden):
    plan = line_rules.judge_documents(documents(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert forbidden not in plan.split("LogicalRDD")[0].split("Repartition")[0]


def test_quality_labels_agree(spark):
    read = lambda name: spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet")
    judged = line_rules.op11_line_first_rules(spark, "/root/testdata/sf0.01").where("n_words >= 20")
    rows = judged.join(read("labels"), "doc_id").select("quality", "kept").collect()
    for quality in (0, 1):
        right = [r.kept == bool(quality) for r in rows if r.quality == quality]
        assert len(right) > 10 and sum(right) >= 0.95 * len(right)
