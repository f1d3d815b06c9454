import hashlib
import math
import random
import re

import regex

from blotter.llm.sanitise import find_private, sanitise

SCHEMA = "doc_id long, text string"
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def ok(kind, v):
    d = re.sub("[^0-9]", "", v)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in v.split(".")),
            "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]


def base(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if ok(k, m.group())]


def base_spans(text):
    return [(m.start(), m.end(), k, m.group()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if ok(k, m.group())]


def entity(kind, value):
    return kind + ":" + (value.lower() if kind in ("email", "ip") else re.sub("[^0-9]", "", value))


def words(text):
    return [(m.start(), m.end(), m.group().lower()) for m in regex.finditer(r"[\p{L}\p{M}]+", text)]


def term_actions(texts, generalise_at=0.8, remove_at=0.9, least_gain=math.log(5)):
    """text -> {term: action}, recounted from the definition over distinct texts."""
    distinct = {t or "" for t in texts}
    holders = {t: {entity(k, v) for _, _, k, v in base_spans(t)} for t in distinct}
    terms = {t: {w for _, _, w in words(t)} for t in distinct}
    out = {}
    for t in distinct:
        best = {}
        for e in holders[t]:
            held = [u for u in distinct if e in holders[u]]
            for w in terms[t]:
                both, having = sum(w in terms[u] for u in held), sum(w in terms[u] for u in distinct)
                p = (both + 1 / 6) / (having + 1 / 3)
                if p >= generalise_at and math.log(p * len(distinct) / len(held)) >= least_gain:
                    best[w] = max(best.get(w, 0), p)
        out[t] = {w: "remove" if p >= remove_at else "generalise" for w, p in best.items()}
    return out


def masked(text, actions):
    """The text with base spans as [KIND], disclosing terms outside of them as [TERM] or removed."""
    base = base_spans(text)
    spans = [(s, -e, f"[{k.upper()}]") for s, e, k, _ in base]
    spans += [(s, -e, "" if actions[w] == "remove" else "[TERM]") for s, e, w in words(text)
              if w in actions and not any(s < y and x < e for x, y, _, _ in base)]
    out, at = "", 0
    for start, end, put in sorted(spans):
        if start >= at:
            out += text[at:start] + put
        at = max(at, -end)
    return out + text[at:]


CARD = "4111 1111 1111 1111"


def texts():
    rng = random.Random(6)
    parts = ["a.b@c.de", "x@y", "x@y.z_q@w.v.u", ".@d.e", "a@b.c.@d.e", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "00001.2.3.0255",
             CARD, CARD.replace(" ", ""), "4111-1111-1111-1112", "5", "12 34", "+1 (415) 555-2671", "+49 30 123456", "+1+2345678901",
             "+", "@", "é😀", "word", "\n", "  ", "99999999999.1.1.1", "+1" + " " * 30 + "x", "%%%", "mail"]
    out = ["".join(rng.choice(parts) + rng.choice(["", " ", " ", "é"]) for _ in range(rng.randint(0, 25))) for _ in range(300)]
    return out + ["", None, "1" * 40_000, "1 " * 20_000, "a" * 60_000, "a@" * 9000, "1." * 20_000, "+1" * 9000, "1.2.3.4 " * 3000]


def test_base_spans_against_the_plain_patterns(spark):
    rows = list(enumerate(texts())) + [(None, "a.b@c.de"), (3, "x 1.2.3.4"), (3, "x 1.2.3.4")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", start int, uid int").repartition(8)
    got = find_private(df, min_support=10 ** 9).collect()
    want = sorted(((d, *[sum(s.startswith(k) for s in base(t)) for k in PATTERNS], ",".join(base(t)),
                    hashlib.sha256(",".join(base(t)).encode()).hexdigest()) for d, t in rows), key=str)
    assert sorted(((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.spans, r.base_sha256) for r in got), key=str) == want
    assert find_private(spark.createDataFrame([], SCHEMA)).count() == 0


def people():
    rows = []
    for i in range(60):
        filler = " ".join(f"f{chr(97 + i % 26)}{'x' * (1 + i // 26)}{chr(97 + k)}" for k in range(6))
        if i % 6 == 0:
            rows.append((i, f"{filler} contact Zorblax about it jane.doe@mail.org the {filler}"))
        else:
            rows.append((i, f"{filler} contact somebody about it u{i}@mail.org the {filler}"))
    return rows


def test_terms_that_disclose_an_entity(spark):
    rows = people()
    df = spark.createDataFrame(rows, SCHEMA)
    found = {r.doc_id: r.spans for r in find_private(df, min_support=3).collect()}
    for d, t in rows:
        terms = [s for s in found[d].split(",") if s.startswith("term")]
        if d % 6:
            assert terms == []
        else:
            at = t.index("Zorblax")
            assert terms == [f"term:{at}:{at + 7}"]     # "contact", "about", "it", "the" occur everywhere
    n, e = 60, 10
    assert math.log(e * n / (e * e)) / math.log(n / e) == 1.0
    clean = {r.doc_id: r.text for r in sanitise(df, min_support=3).collect()}
    assert "Zorblax" not in clean[0] and "contact  about it [EMAIL] the" in clean[0]
    assert clean[1] == rows[1][1].replace("u1@mail.org", "[EMAIL]")


def test_sanitise_keeps_columns_and_replaces_overlaps_once(spark):
    rows = [(1, f"pay {CARD} or +1 (415) 555-2671 é 1.2.3.4!", 5), (2, None, 6), (None, "nothing", 7), (3, "", 8),
            (4, "+4111111111111111 x", 9)]
    df = spark.createDataFrame(rows, SCHEMA + ", kind int")
    out = sanitise(df)
    assert out.columns == df.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert got[1] == "pay [CARD] or [PHONE] é [IP]!" and got[2] is None and got[None] == "nothing" and got[3] == ""
    assert got[4] == "+[CARD] x"


def test_plan_has_no_python(spark, sf_dir):
    plan = find_private(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_terms_of_the_whole_document(spark):
    rows = people()
    far = " plain words" * 40
    rows += [(100 + i, f"Quuxly (2024) {CARD}{far} quuxly {far} bar{'x' * i}") for i in range(4)]
    rows += [(200 + i, f"Vexley j@x.org, jd@y.org {'y' * (i + 1)}") for i in range(4)]
    found = {r.doc_id: r.spans.split(",") for r in find_private(spark.createDataFrame(rows, SCHEMA), min_support=3).collect()}
    for d, t in rows[60:64]:
        at = [m.start() for m in re.finditer("quuxly", t.lower())]
        assert len(at) == 2 and all(f"term:{a}:{a + 6}" in found[d] for a in at)
    assert all("term:0:6" in found[d] for d, _ in rows[64:])


def test_copies_are_no_evidence(spark):
    filler = [(200 + i, f"somebody wrote {'z' * (i % 50 + 1)} {'v' * (i // 50 + 1)}") for i in range(100)]
    rows = [(i, f"Zorblax and a.b@c.de {'xyw'[i]}") for i in range(3)] + filler
    copied = rows + [(1000 + 100 * i + k, rows[i][1]) for i in range(3) for k in range(30)]
    once, often = ({r.doc_id: r.spans for r in find_private(spark.createDataFrame(x, SCHEMA), min_support=3).collect()}
                   for x in (rows, copied))
    assert "term:0:7" in once[0].split(",")
    assert {d: often[d] for d in once} == once and all(often[1000 + 100 * i + k] == once[i] for i in range(3) for k in range(30))


def test_entities_that_occur_once_or_twice(spark):
    rows = [(0, "Zorblax wrote from a.b@c.de today"), (1, "Quuxly wrote again from +1 (415) 555-2671 today"),
            (2, "Quuxly wrote from +1 (415) 555-2671 today")]
    rows += [(10 + i, f"somebody wrote again from {'z' * (i % 50 + 1)} {'v' * (i // 50 + 1)} today") for i in range(100)]
    df = spark.createDataFrame(rows, SCHEMA)
    terms = {r.doc_id: [s for s in r.spans.split(",") if s.startswith("term")] for r in find_private(df).collect()}
    assert terms.pop(0) == ["term:0:7"] and terms.pop(1) == ["term:0:6"] and terms.pop(2) == ["term:0:6"]
    assert not any(terms.values())


def test_every_span_against_a_recount(spark):
    """Terms and actions recounted from the definition: copies, shared and single entities, repeated rows, odd columns."""
    rng = random.Random(11)
    names = [f"n{chr(97 + k)}{'x' * k}" for k in range(12)]
    rows = []
    for i in range(90):
        k = rng.randrange(12)
        mail, who = rng.choice([(f"Mail{k}@host.org", names[k]), (f"u{i}@host.org", "Q" * (i + 1)), ("1.2.3.4", names[k]),
                                (CARD, "somebody"), ("", "somebody")])
        rows.append((i, f"{who} wrote {rng.choice(['about', 'to', 'of'])} {mail} {who.lower()} {'é' * (i % 7 + 1)}"))
    rows += [(200 + i, rows[i][1]) for i in range(0, 90, 7)] + [rows[3], rows[3], (None, rows[4][1]), (300, None)]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA + ", _cuts int, _id int, _loc int")
    actions = term_actions([t for _, t in rows])
    assert any(actions.values()) and {a for x in actions.values() for a in x.values()} == {"remove", "generalise"}
    out = sanitise(df)
    assert out.columns == df.columns
    want = [(d, None if t is None else masked(t, actions[t])) for d, t in rows]
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted(want, key=str)


def test_verdict_does_not_depend_on_the_size_of_the_table(spark):
    rows = [(0, "Zorblax a.b@c.de plain"), (1, "Quuxly x@y.org plain"), (2, "Quuxly only plain")]
    for more in (40, 400):
        filler = [(10 + i, f"plain {'z' * (i % 40 + 1)} {'v' * (i // 40 + 1)}") for i in range(more)]
        found = {r.doc_id: r.spans for r in find_private(spark.createDataFrame(rows + filler, SCHEMA)).collect()}
        assert [found[d].split(",")[1:] for d in range(3)] == [["term:0:7"], [], []]
