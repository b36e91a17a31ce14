import hashlib
import re
from collections import Counter

from driftsweep.llm import pii

#: The contract's own patterns, without possessive parts.
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def passes(kind, s):
    d = re.sub("[^0-9]", "", s)
    return {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in s.split(".")),
            "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]


def brute(text):
    spans = sorted((m.start(), n, m.end(), k) for n, (k, p) in enumerate(PATTERNS.items())
                   for m in re.finditer(p, text or "") if passes(k, m.group()))
    return [f"{k}:{a}:{b}" for a, _, b, k in spans]


TEXTS = [
    "é😀 a@b.c_d@e.fg x@y@z.com 1.2.3.4.5.6.7.8.9 256.1.1.1 4111 1111-1111 1111 +1 (222) 333-4444", "9" * 3000,
    "a" * 5000 + " a.b@c.d " * 700, "0001.02.003.000255 +1+2 333 444 5555 +12", "@ a@ @b.c a@b a@b. a@.b a@b.c.", "+1 234 567 8901.",
    "4111111111111111 4111-1111-1111-1111 4111  1111 1111 1111 1.1.1", "1.2.3.4 " * 400, "300.1.1.1.1", "%@a.b --@--.-- +@+.+",
    "00000000000000 0000000000000 5555 5555 5555 4444", "joe [at] mail (dot) example.com", "card 4111.1111.1111.1111 tel 212-555-1212"]


def test_base_spans_like_the_contract(spark, small):
    docs = small.select("doc_id", "text").union(spark.createDataFrame([(91000 + i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string"))
    got = pii.find(docs).collect()
    want = Counter()
    for r in docs.collect():
        s = brute(r.text)
        want[(r.doc_id, *(sum(x.startswith(k + ":") for x in s) for k in PATTERNS), hashlib.sha256(",".join(s).encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == want
    by_text = {r.doc_id: r.text for r in docs.collect()}
    for r in got:
        if r.doc_id is not None and r.doc_id >= 91000 and r.n_added == 0:
            assert r.spans == ",".join(brute(by_text[r.doc_id]))


def test_added_spans_where_the_corpus_supports_them(spark):
    good = ["4111111111111111", "5500005555555559", "4012888888881881", "378282246310005"]
    docs = [(i, f"pay {good[i % 4]} now {good[(i + 1) % 4][:-1]}{i % 10} x@y{i}.com +1 212 555 {1000 + i}") for i in range(400)]
    docs += [(1000, "number 4111.1111.1111.1111 here"), (1001, "number 4111.1111.1111.1112 here")]
    got = {r.doc_id: r for r in pii.find(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[1000].spans == "card:7:26" and got[1000].n_added == 1 and got[1000].n_card == 0
    assert got[1001].spans == "" and got[1001].base_sha256 == hashlib.sha256(b"").hexdigest()


def test_boosting_learns_a_rule_and_calibration_is_monotone():
    cells = {c: ((50, 1) if pii._features(c)[3] else (2, 60)) for c in range(0, pii.CELLS // 4, 37)}
    score = pii.boost(cells)
    yes = [score(c) for c in cells if pii._features(c)[3]]
    no = [score(c) for c in cells if not pii._features(c)[3]]
    assert min(yes) > max(no)
    prob = pii.calibrate([(0.1, 1, 9), (0.2, 5, 5), (0.3, 4, 6), (0.9, 30, 0)])
    assert [prob(x) for x in (0.0, 0.1, 0.25, 0.3, 2)] == sorted(prob(x) for x in (0.0, 0.1, 0.25, 0.3, 2))


def test_no_python_in_the_plan_and_empty(empty):
    df = pii.candidates(empty)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert pii.find(empty).count() == 0


def phones(cue_order, near):
    """4,000 valid phones, half of them with a cue, and numbers of orders; two candidates at the end."""
    rows = [(i, f"{('please call', 'tel', 'we wrote', cue_order if i % 100 == 0 else 'then')[i % 4]} +1 {200 + i % 700} 555 {1000 + i} today") for i in range(4000)]
    rows += [(4000 + i, f"{('order no', 'invoice')[i % 2]} {100 + i}-{20000 + i}-{i % 90 + 10} sent") for i in range(near)]
    return rows + [(9000, "tel 212-555-1212 today"), (9001, "order no 212-555-1212 today"), (9002, "then 212-555-1212 today")]


def test_a_cue_word_decides(spark):
    """Some valid phones follow ``order no``, so the trees, not an unseen context, keep the number of an order out."""
    docs = spark.createDataFrame(phones("order no", 3000), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find(docs).filter("doc_id >= 9000").collect()}
    assert got[9000].spans == "phone:4:16" and got[9000].n_added == 1 and got[9000].n_phone == 0
    assert got[9001].spans == "" and got[9001].n_added == 0


def test_contexts_never_seen_with_personal_data_add_nothing(spark):
    docs = spark.createDataFrame(phones("then", 0), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.find(docs).filter("doc_id >= 9000").collect()}
    assert got == {9000: "phone:4:16", 9001: "", 9002: "phone:5:17"}


def test_check_and_kind_are_no_features():
    kind, *features = pii._features(pii.CELLS - 1)
    assert kind == 3 and len(features) == 6
    counts = {c: ((9, 1) if pii._features(c)[1] == 4 else (1, 9)) for c in range(0, pii.CELLS // 4, 11)}
    shuffled = dict(sorted(counts.items(), key=lambda x: -x[0]))
    assert [pii.boost(counts)(c) for c in counts] == [pii.boost(shuffled)(c) for c in counts]
