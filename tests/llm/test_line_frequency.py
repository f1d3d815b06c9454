import random
import re
from collections import Counter

from blotter.llm.line_frequency import line_rules, remove_frequent_lines

SCHEMA = "doc_id long, text string, source string"


def norm(text):
    flat = re.sub(r"[\x20\x09\x0B-\x0D]+", " ", text or "").lower()
    return [x.strip(" ") for x in flat.split("\n") if x.strip(" ")]


def brute(rows, max_docs, percent):
    docs = {}
    for _, t, h in rows:
        for x in norm(t):
            docs.setdefault((h or "", x), set()).add("\n".join(norm(t)))
    out = []
    for d, t, h in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        wins = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
        seen = Counter(wins)
        cover = {p for i, w in enumerate(wins) if seen[w] > 1 for p in range(i, i + 5)}
        raw = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        gone = sum(len(x.split(" ")) for x in norm(t) if len(docs[(h or "", x)]) > max_docs)
        failed = len(words) < 10 or 100 * len(cover) > 20 * len(words)
        out.append((d, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(raw) - len(set(raw)),
                    len(cover), gone, failed, not failed and 100 * (len(words) - gone) >= percent * len(words)))
    return sorted(out, key=str)


FIELDS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_words",
          "base_failed", "kept"]


def rows_of(df):
    return sorted((tuple(r[f] for f in FIELDS) for r in df.collect()), key=str)


def corpus():
    rng = random.Random(4)
    common = ["All rights  reserved now.", "HOME | about | contact", "menu"]
    rows = []
    for i in range(120):
        lines = [" ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randint(0, 14))) for _ in range(rng.randint(0, 4))]
        lines += rng.sample(common, rng.randint(0, 3))
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines), f"h{i % 2}"))
    rows += [(200 + k, rows[7][1], "h1") for k in range(30)]              # copies count once
    rows += [(300, None, None), (301, "", None), (302, " \n\t\n", "h0"), (None, "a b c d e " * 9, None),
             (303, "Wh " * 3000, "h0"), (304, "é😀 ## " * 20 + "\n\n", ""), (303, "Wh " * 3000, "h0")]
    return rows


def test_against_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", uid int, line int").repartition(5)
    for limit, percent in ((20, 30), (20, 90), (0, 30), (1000, 100)):
        assert rows_of(line_rules(df, max_docs=limit, min_kept_percent=percent)) == brute(rows, limit, percent)
    assert line_rules(spark.createDataFrame([], SCHEMA)).count() == 0


def test_plan_has_no_python(spark, sf_dir):
    plan = line_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_text_loses_its_frequent_lines(spark):
    rows = [(i, f"Shared   Line here\n{' '.join(f'u{i}_{k}' for k in range(20))}", "h") for i in range(6)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = remove_frequent_lines(df, line_rules(df, max_docs=3))
    assert out.columns == df.columns
    assert sorted(r.text for r in out.collect()) == sorted(t.split("\n")[1] for _, t, _ in rows)
