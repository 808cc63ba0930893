"""Line rules, decontamination and mixing against brute force."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from llm_helpers import SMALL, prose, rows_of
from pyspark.sql import functions as F

from seriesmill.llm import line_rules, mixing, words
from seriesmill.llm.decontamination import contaminated, item_sketches, without_leaks
from seriesmill.llm.prefix import levels_for, random_key, running_total

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    found = WORD.findall(text)
    windows = Counter(tuple(found[i : i + 5]) for i in range(len(found) - 4))
    repeated = {i + k for i in range(len(found) - 4) if windows[tuple(found[i : i + 5])] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated)
    )


def brute_judge(rows):
    """Verdicts by plain loops; a document is its text."""
    holders, texts = defaultdict(set), defaultdict(set)
    for _, text, host in rows:
        if WORD.search(text or ""):
            texts[host].add(text)
            for line in text.split("\n"):
                if WORD.search(line):
                    holders[host, line_rules.normalised(line)].add(text)
    out = []
    for doc_id, text, host in rows:
        numbers = base(text)
        removed = sum(
            len(WORD.findall(line)) for line in (text or "").split("\n")
            if WORD.search(line) and len(holders[host, line_rules.normalised(line)]) >= 20
            and 100 * len(holders[host, line_rules.normalised(line)]) >= 10 * len(texts[host])
        )
        failed = numbers[0] < 10 or 100 * numbers[4] > 20 * numbers[0]
        left = numbers[0] - removed
        depleted = removed > 0 and (left < 10 or 100 * left < 20 * numbers[0])
        out.append((doc_id, *numbers, failed, not (failed or depleted), removed))
    return sorted(out)


COLUMNS = (
    "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "line_words_removed"
)


def test_rules_on_the_small_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "source")
    assert rows_of(line_rules.judge(docs), *COLUMNS) == brute_judge([tuple(r) for r in docs.collect()])


def test_boilerplate_removes_and_depletes(documents):
    """A line of many documents is removed; who has little else is rejected; copies count once."""
    rng = random.Random(2)
    notice = "All pages of this site may be read with 1 glass of water at the table"
    rows = [(k, f"{prose(rng, 40)}\n {notice.replace('1', str(k % 7))} \n{prose(rng, 12)}", "a") for k in range(60)]
    rows += [(100 + k, f"{notice.upper()}\n{prose(rng, 3)}", "a") for k in range(5)]
    copied = prose(rng, 30)
    rows += [(200 + k, copied, "a") for k in range(90)]
    near = prose(rng, 60).split()
    rows += [(300 + k, " ".join(near[:-1] + [chr(97 + k // 26) + chr(97 + k % 26)]) + "\n" + prose(rng, 5), "a") for k in range(90)]
    rows += [(400 + k, f"{prose(rng, 20)}\n{notice}", "b") for k in range(10)]
    found = rows_of(line_rules.judge(documents(rows)), *COLUMNS)
    assert found == brute_judge(rows)
    kept = {r[0]: r[7] for r in found}
    assert [i for i, k in kept.items() if not k] == [100, 101, 102, 103, 104]
    assert {r[-1] for r in found if r[0] < 60} == {16} and {r[-1] for r in found if r[0] >= 400} == {0}
    assert sorted(r.doc_id for r in line_rules.keep_good(documents(rows)).collect()) == sorted(i for i, k in kept.items() if k)


def test_rules_edges(documents):
    rows = [
        (1, None, "a"), (2, "", None), (3, "\n \n", "a"), (4, "a b c d e a b c d e f g h i j k", None),
        (5, "x\x1cy z q\n" * 30, "a"), (6, "é#*$%&|<> " * 4000, "a"), (6, "é#*$%&|<> " * 4000, "a"), (7, "1 2 3 4 5 6 7 8 9 10", ""),
    ]
    found = rows_of(line_rules.judge(documents(rows, "n_words kept row host line")), *COLUMNS)
    assert found == brute_judge(rows)
    assert line_rules.judge(documents([])).collect() == []
    assert line_rules.keep_good(documents([(None, prose(random.Random(1), 20)), (None, "x")])).count() == 2


def brute_cleaned(rows):
    """Kept documents without boilerplate, counting texts by plain loops."""
    holders, texts = defaultdict(set), defaultdict(set)
    for _, text, host in rows:
        if WORD.search(text or ""):
            texts[host].add(text)
            for line in text.split("\n"):
                holders[host, line_rules.normalised(line)].add(text)
    out = []
    for doc_id, text, host in rows:
        often = [
            line for line in (text or "").split("\n") if WORD.search(line)
            and len(holders[host, line_rules.normalised(line)]) >= max(20, len(texts[host]) / 10)
        ]
        n, _, _, _, repeated = base(text)
        left = n - sum(len(WORD.findall(line)) for line in often)
        kept = not (n < 10 or 100 * repeated > 20 * n or (often and (left < 10 or 100 * left < 20 * n)))
        clean = "\n".join(line for line in (text or "").split("\n") if line not in often) if often else text
        out.append((doc_id, kept, n - left, clean))
    return out


def noticed(rng):
    """300 documents of a host, 40 of which are mostly one notice, and 60 with a short line in it."""
    notice = prose(rng, 100)
    rows = [(k, f"{notice}\n{prose(rng, 22)}", "a") for k in range(40)]
    line = prose(rng, 9)
    rows += [(100 + k, f"{prose(rng, 40)}\n\n{line.upper()} \n{prose(rng, 12)}", "a") for k in range(60)]
    rows += [(200 + k, prose(rng, 50), "a") for k in range(200)]
    return rows + [(500 + k, f"{line}\n{prose(rng, 30)}", None) for k in range(15)]


def test_depleted_documents_count_one_by_one(documents):
    """Documents that are mostly one notice share its smallest window hash, and still are distinct texts."""
    rows = noticed(random.Random(5))
    found = rows_of(line_rules.judge(documents(rows)), "doc_id", "kept", "line_words_removed")
    assert found == [r[:3] for r in brute_cleaned(rows)]
    assert not any(kept for doc_id, kept, _ in found if doc_id < 40)
    assert {r.doc_id for r in line_rules.keep_good(documents(rows)).collect()} == {r[0] for r in rows if r[0] >= 40}


def test_boilerplate_leaves_the_texts(documents):
    """Lines that are judged removed are not in the texts of the judged or of the kept documents."""
    rows = noticed(random.Random(5)) + [(900, None, "a"), (901, "", None)]
    expected = brute_cleaned(rows)
    table = documents(rows, "_x lines")
    judged = rows_of(line_rules.judge(table), "doc_id", "text")
    assert judged == [(i, text) for i, _, _, text in expected]
    good = line_rules.keep_good(table)
    assert good.columns == table.columns
    clean = [(i, text, len(text)) for i, kept, _, text in expected if kept]
    assert rows_of(good, "doc_id", "text", "n_chars") == clean
    assert sum(removed for _, kept, removed, _ in expected if kept) == 60 * 9


def test_base_measures_in_sql(spark):
    sql = r"""
    WITH w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM documents),
    place AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM w),
    win AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, v) > 1 AS twice
      FROM (SELECT doc_id, unnest(range(1, len(w) - 3)) AS i, array_to_string(w[unnest(range(1, len(w) - 3)):unnest(range(1, len(w) - 3)) + 4], ' ') AS v FROM w)),
    hit AS (SELECT DISTINCT doc_id, i + k AS i FROM win, range(5) r(k) WHERE twice)
    SELECT doc_id, len(w)::BIGINT AS n_words, len(array_to_string(w, ''))::BIGINT AS word_chars,
      len(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
      (SELECT count(*) FROM hit WHERE hit.doc_id = w.doc_id) AS n_repeat_words FROM w
    """
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_repeat_words")
    assert rows_of(line_rules.judge(docs), *names) == sorted(con.execute(sql).fetchall())


def test_leaks(spark, documents):
    rng = random.Random(8)
    items = [(k, prose(rng, n)) for k, n in enumerate((5, 6, 9, 14, 30, 33, 64, 150))]
    items += [(50, None), (51, ""), (52, "too short a"), (4, items[4][1]), (None, prose(rng, 20))]
    rows = []
    for k, (_, text) in enumerate(items[:8]):
        cut = text.split()
        rows.append((k, f"{prose(rng, 3000)} {text.upper().replace(' ', ',  ')}! {prose(rng, 50)}"))
        rows.append((100 + k, " ".join(cut[: int(len(cut) * 0.5)])))
        rows.append((200 + k, " ".join([*cut[: len(cut) * 9 // 10], "other", *cut[len(cut) * 9 // 10 + 1 :]])))
    rows += [(300, None), (301, ""), (None, items[5][1]), (302, "a b c"), (303, items[-1][1]), (0, "again " + items[6][1])]

    def runs(text):
        found = re.findall(r"[^\W_]+", (text or "").lower())
        return {tuple(found[i : i + 5]) for i in range(len(found) - 4)}

    expected = {}
    for doc_id, text in rows:
        for item_id, item in items:
            own = runs(item)
            if own and 100 * len(own & runs(text)) >= 80 * len(own):
                expected[doc_id, item_id] = (len(own & runs(text)), len(own))
    table = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, shared string")
    found = contaminated(documents(rows, "item_id hash size tokens"), table)
    got = {(r.doc_id, r.item_id): (r.shared, r.size) for r in found.collect()}
    assert got == expected and len(got) > 12
    clean = without_leaks(documents(rows), table)
    leaks = {d for d, _ in expected}
    assert sorted((r.doc_id is None, r.doc_id) for r in clean.collect()) == sorted((i is None, i) for i, _ in rows if i not in leaks)
    assert contaminated(documents([]), table).count() == contaminated(documents(rows), table.where("false")).count() == 0


def test_short_items_are_found_as_a_whole(spark, documents):
    """Items of one to four words match documents that hold these words in a row."""
    items = [(1, "Capital of France"), (2, "zebra"), (3, "four words stand here"), (4, "one, two"), (5, "a longer item of seven words here"), (6, "...")]
    rows = [
        (1, "What is the capital\nof France? Paris."), (2, "the capital city of France"), (3, "A Zebra, and zebras"), (4, "zebras only"),
        (5, "here: four words stand. Here"), (6, "four words stand there"), (7, "ONE - TWO"), (8, "two one"), (9, "a longer item of seven words here"),
        (10, "one"), (11, None), (12, ""),
    ]
    table = spark.createDataFrame(items, "item_id long, text string")
    found = contaminated(documents(rows, "width hash"), table)
    assert rows_of(found, "doc_id", "item_id", "shared", "size") == [
        (1, 1, 1, 1), (3, 2, 1, 1), (5, 3, 1, 1), (7, 4, 1, 1), (9, 5, 3, 3),
    ]
    few = table.where("item_id = 2")
    assert sorted(r.doc_id for r in contaminated(documents(rows), few).collect()) == [3]
    assert sorted(r.doc_id for r in without_leaks(documents(rows), table).collect()) == [2, 4, 6, 8, 10, 11, 12]


def test_sketch_cannot_miss(spark):
    """An item may lose a fifth of its shingles, and its sketch still keeps one of the rest."""
    items = spark.createDataFrame([(n, prose(random.Random(n), n + 4)) for n in range(1, 130)], "item_id long, text string")
    for row in item_sketches(items).collect():
        allowed = row["size"] - -(-80 * row["size"] // 100)
        assert allowed < len(row["sketch"]) <= max(allowed * 2 + 2, 2), row["size"]


def brute_mix(rows):
    sizes = [len(WORD.findall(t or "")) for _, t, _ in rows]
    per = Counter()
    for (_, _, s), n in zip(rows, sizes):
        per[s] += n
    order = sorted(per, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, target = 1.5 * sum(sizes), {}
    open_ = set(order)
    while True:
        left = total - sum(target.values())
        level = left / max(1, sum(weight[s] for s in open_))
        full = {s for s in open_ if level * weight[s] >= 2 * per[s]}
        if not full:
            break
        target |= {s: 2.0 * per[s] for s in full}
        open_ -= full
    target |= {s: level * weight[s] for s in open_}
    return per, target


def test_mix(documents):
    rng = random.Random(4)
    rows = [(k, prose(rng, rng.randrange(0, 80)), rng.choice(["hot"] * 9 + ["é", "b", "Z", None])) for k in range(400)]
    rows += [(900, None, "b"), (901, "", "empty"), (902, "a " * 30_000, "Z"), (903, "x y", "hot"), (903, "x y", "hot")]
    per, target = brute_mix(rows)
    table = documents(rows, "size key before source_size")
    found = mixing.mix(table).collect()
    assert len(found) == len(rows)
    taken = Counter()
    for r in found:
        assert r.source_size == per[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(0 <= target[s] - taken[s] < 1.001 for s in per)
    # Whole epochs first: in a source, at most one document is cut inside.
    inside = Counter(r.source for r in found if r["size"] and r.taken % r["size"])
    assert all(n == 1 for n in inside.values())
    again = mixing.mix(table.repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_mixed_documents(documents):
    rng = random.Random(6)
    rows = [(k, prose(rng, 50), rng.choice("abc")) for k in range(90)] + [(200, None, "a"), (201, "", None)]
    table = documents(rows)
    out = mixing.mixed_documents(table)
    assert out.columns == table.columns
    copies = Counter(r.doc_id for r in out.collect())
    taken = {r.doc_id: (r.taken, r["size"]) for r in mixing.mix(table).collect()}
    assert all(copies[i] == ((2 * t + n) // (2 * n) if n else 1) for i, (t, n) in taken.items())
    assert max(copies.values()) <= 2 and copies[200] == copies[201] == 1


def test_mix_empty(documents):
    assert mixing.mix(documents([])).collect() == []
    assert [r.taken for r in mixing.mix(documents([(1, ""), (2, None)])).collect()] == [0, 0]


@pytest.mark.parametrize("rows", [10, 10**8, 10**12])
def test_running_total_at_any_depth(spark, rows):
    """The number of cells changes with the stated size of the table, the sums do not."""
    table = spark.range(500).select(
        "id", F.when(F.col("id") % 3 != 0, F.col("id") % 3).alias("g"), random_key(F.lit("k"), F.col("id")).alias("key"), (F.col("id") % 7).alias("v")
    )
    found = running_total(table, ["g"], ["key"], "v", rows).collect()
    sums = Counter()
    for r in sorted(found, key=lambda r: r.key):
        assert r.before == sums[r.g]
        sums[r.g] += r.v
    assert len(found) == 500 and levels_for(rows) == {10: 1, 10**8: 2, 10**12: 3}[rows]
