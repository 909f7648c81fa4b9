import hashlib
import re

from tidemark.llm.secret_scan import ACCESS, ASSIGN, ENDPOINT, HEX, KINDS, OPAQUE, SCOPE, redact_secrets, secret_report

NAMES = [k.name for k in KINDS]
ROWS = [(1, None), (2, ""), (3, "x password=abcdef y"), (4, "token=token=abcdefg secret: 'abc'"),
        (5, "é👍 AKIA" + "A1" * 8 + " and " + "ab12" * 8), (6, "AKIA12345 then token = abc"),
        (7, "AKIA12345" + " " * (SCOPE + 1) + "token = abc"), (8, "https://a.b/c key " + "aB3" * 12),
        (9, "secret=token:abcdefgh API_KEY=xxxxxx ApiKey : 'zzzzzzzz"), (None, "password=hunter22"),
        (3, "x password=abcdef y"), (10, "AKIA123 0123456789abcdef " + "z" * 100 + " passwd=12 http://h/x"),
        (11, "paſſword=abcdefgh PassWord=abcdefgh"), (12, "deadbeef" * 2 + " alone, " + "https://only.an/endpoint"),
        (13, "password=" + "a" * 5 + " " * 10 + "AKIA" + "Z9" * 8), (14, "q " * 60_000 + "token=abcdefgh"),
        (15, " ".join(f"token=value{i}" for i in range(300))), (16, "password==abc secret=\"'abcdef")]


def matches(pattern, text):
    return re.finditer(pattern, text, re.A)


def spans(text):
    """The contract read plainly, with linking by comparing every pair of parts."""
    base, weak = [], []
    for m in matches(ASSIGN, text):
        (base if len(m[2]) >= 6 else weak).append((m.start(), 0 if len(m[2]) >= 6 else 3, m.end()))
    for m in matches(ACCESS, text):
        (base if len(m[0]) >= 20 else weak).append((m.start(), 1 if len(m[0]) >= 20 else 4, m.end()))
    for m in matches(HEX, text):
        if len(m[0]) >= 24:
            base.append((m.start(), 2, m.end()))
        elif len(m[0]) >= 16 and re.search("[0-9]", m[0]) and re.search("[a-f]", m[0]):
            weak.append((m.start(), 5, m.end()))
    for m in matches(OPAQUE, text):
        if all(re.search(c, m[0]) for c in ("[0-9]", "[A-Z]", "[a-z]")):
            weak.append((m.start(), 6, m.end()))
    for m in matches(ENDPOINT, text):
        weak.append((m.start(), 7, m.end()))
    weak = [w for w in weak if not any(b[0] < w[2] and w[0] < b[2] for b in base)]
    parts = sorted(base + weak)

    def completed(x):
        role = KINDS[x[1]].role
        needs = ("id", "endpoint") if role == "secret" else ("secret",)
        return any(KINDS[y[1]].role in needs and max(y[0] - x[2], x[0] - y[2]) <= SCOPE for y in parts if y is not x)
    return sorted(base), sorted(w for w in weak if completed(w))


def listed(found):
    return ",".join(f"{NAMES[k]}:{s}:{e}" for s, k, e in found)


def test_equals_plain_form(spark, docs):
    got = secret_report(docs(ROWS)).collect()
    want = []
    for i, t in ROWS:
        base, added = spans(t or "")
        want.append((str(i), *(sum(k == j for _, k, _ in base) for j in range(3)),
                     hashlib.sha256(listed(base).encode()).hexdigest(), listed(sorted(base + added)), len(added)))
    assert sorted((str(r.doc_id), r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans, r.n_linked)
                  for r in got) == sorted(want)
    assert sum(w[-1] for w in want) >= 8


def test_weak_parts_alone_are_not_reported(spark, docs):
    got = {r.doc_id: r.spans for r in secret_report(docs(ROWS)).collect()}
    assert got[7] == "" and got[6] == "weak_access:0:9,weak_assign:15:26"


def test_redaction_keeps_rows_and_columns(spark, docs):
    df = docs(ROWS)
    out = redact_secrets(df)
    assert out.columns == df.columns and out.dtypes == df.dtypes
    rows = out.select("doc_id", "text", "n_chars").collect()
    assert len(rows) == len(ROWS)
    for (i, t), r in zip(ROWS, rows):
        base, added = spans(t or "")
        want, at = "", 0
        for s, _, e in sorted(base + added):
            if s >= at:
                want += (t or "")[at:s] + "[SECRET]"
            at = max(at, e)
        want += (t or "")[at:]
        assert r.text == (None if t is None else want)
        assert r.n_chars == (None if t is None else len(want))


def test_no_python_in_the_plan(spark, docs):
    plan = secret_report(docs(ROWS))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
    assert secret_report(docs([])).count() == 0


def test_work_grows_with_the_matches(spark, docs):
    """Four times the secrets of a text take about four times as long, and none is lost."""
    import time
    took = {}
    for n in (8_000, 32_000):
        text = " ".join(f"token=value{i:07d}" for i in range(n))
        df = docs([(1, text)])
        secret_report(df).collect()
        best = []
        for _ in range(2):
            t = time.perf_counter()
            r = secret_report(df).collect()[0]
            best.append(time.perf_counter() - t)
            assert r.n_assign == n and r.spans.count("assign:") == n
        took[n] = min(best)
        assert redact_secrets(df).collect()[0].text == " ".join(["[SECRET]"] * n)
    assert took[32_000] < 8 * took[8_000] + 2


def test_overlaps_and_many_parts_of_all_kinds(spark, docs):
    import random
    rng = random.Random(8)
    parts = ["password=abcdef", "token:abc", "AKIA" + "Z9" * 8, "AKIA12345", "deadbeef" * 3, "0a1b" * 4, "aB3" * 12, "s3://x/y",
             "secret=" + "0a1b" * 5, "https://h/token=abcdefgh", "plain", "é👍", " " * 150, "x" * 60]
    rows = [(i, rng.choice([" ", ""]).join(rng.choice(parts) for _ in range(rng.randint(0, 200)))) for i in range(150)]
    got = {r.doc_id: (r.spans, r.n_linked) for r in secret_report(docs(rows)).collect()}
    hidden = {r.doc_id: r.text for r in redact_secrets(docs(rows)).collect()}
    for i, t in rows:
        base, added = spans(t)
        assert got[i] == (listed(sorted(base + added)), len(added)), i
        want, at = "", 0
        for s, _, e in sorted(base + added):
            if s >= at:
                want += t[at:s] + "[SECRET]"
            at = max(at, e)
        assert hidden[i] == want + t[at:]
