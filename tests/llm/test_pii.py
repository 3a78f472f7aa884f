import math
import random
import re

import pytest

from shardstream.llm.pii import DOUBT, KINDS, LEAST_INSTANCES, TRUSTED, find_spans, redact, trusted_patterns
from shardstream.llm.queries import op7_personal_data
from tests.llm.data import documents, no_documents, odd_documents

FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, value):
    number = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(number))]
        return 14 <= len(number) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind == "email" or 10 <= len(number) <= 15


def by_hand(text):
    found = [(m.start(), list(FORMS).index(k), m.end(), k) for k, f in FORMS.items() for m in re.finditer(f, text or "") if valid(k, m[0])]
    return [(k, a, b) for a, _, b, k in sorted(found)]


def base(row):
    return [(s.kind, s.start, s.end) for s in row.base]


def test_all_documents(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = op7_personal_data(spark, small).collect()
    assert len(rows) == len(texts)
    for row in rows:
        want = by_hand(texts[row.doc_id])
        assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == tuple(sum(k == x for k, _, _ in want) for x in FORMS)
        if "id:" not in row.spans:
            assert row.spans == ",".join(f"{k}:{a}:{b}" for k, a, b in want)


TEXTS = [
    "a@b.co, x@y, a@b.co_x@d.com; .@-.-", "1.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 000255.0.0.1 1..2.3.4",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 5500000000000004 3782 822463 10005 12345678901234567890",
    "+1 (243) 555-5526 +12 +1234567890123456 +1-2.3(4)5 6 7 8 9 0 +1 243 555 5526 )", "4111  1111 1111 1111 0000000000000000",
    "\U0001f600é a@b.co \U0001f600 10.0.0.1", "9" * 5000, "1 " * 4000, "x" * 5000 + "@", "+1" + " " * 3000, "1." * 3000, "a@" * 2000,
    "10.0.0.1@x.com +1.2.3.4567890 4111.1111.1111.1111",
]


def test_forms(spark):
    rows = find_spans(documents(spark, TEXTS)).orderBy("doc_id").collect()
    for row, text in zip(rows, TEXTS, strict=True):
        assert base(row) == by_hand(text), text[:60]
        assert all(s.value == text[s.start : s.end] for s in row.spans)


def test_contexts_of_seeds_find_unseen_identifiers(spark):
    cards = ["4111111111111111", "5500000000000004", "340000000000009", "30000000000004", "6011000000000004", "4242424242424242"]
    texts = [f"some words {k} then my account number {c} thanks a lot" for k, c in enumerate(cards)]
    texts += ["he gave my account number XK-99-1234-77 thanks again", "room 101B-202C is on floor 7 now", "my account number soon"]
    rows = find_spans(documents(spark, texts)).orderBy("doc_id").collect()
    new = {r.doc_id: [s.value for s in r.spans if s.kind == "id"] for r in rows}
    assert new.pop(6) == ["XK-99-1234-77"]
    assert not any(new.values())
    assert [base(r) for r in rows] == [by_hand(t) for t in texts]


def test_identifiers_of_any_form_between_trusted_contexts(spark):
    cards = ["4111111111111111", "5500000000000004", "340000000000009", "30000000000004", "6011000000000004", "4242424242424242"]
    texts = [f"my account number {c} thanks a lot" for c in cards]
    shapes = ["555 123 4567", "4111 11 11", "(555) 123-4567", "j.doe", "k" * 70 + "-" + "9" * 30]
    texts += [f"\U0001f600 \u0130l gave my account number {v} thanks a lot" for v in shapes]
    texts += ["my account number soon", "a count of people said thanks a lot", "thanks a lot for the account number"]
    texts += ["my account number " + "word " * 13 + "thanks a lot"]
    rows = find_spans(documents(spark, texts)).orderBy("doc_id").collect()
    for row, text in zip(rows, texts, strict=True):
        assert [s.value for s in row.spans if s.kind == "id"] == [v for v in shapes if f"number {v} thanks" in text]
        assert all(s.value == text[s.start : s.end] for s in row.spans)
    out = {r.doc_id: r.text for r in redact(documents(spark, texts)).collect()}
    assert out[8] == "\U0001f600 \u0130l gave my account number <id> thanks a lot"


def test_contexts_that_hold_mostly_other_words_find_none(spark):
    mails = [f"please contact u{k}@b.co, for details" for k in range(6)]
    others = [f"please contact {w}, for details" for w in ("us", "me", "the team", "our office", "them", "him", "her", "support")]
    rows = find_spans(documents(spark, mails + others)).collect()
    assert not any(s.kind == "id" for r in rows for s in r.spans)


def test_a_pattern_seen_in_copies_of_one_document_proves_nothing(spark):
    texts = ["my account number 4111111111111111 thanks"] * 30 + ["my account number XK-99-1234-77 thanks"]
    rows = find_spans(documents(spark, texts)).collect()
    assert not any(s.kind == "id" for r in rows for s in r.spans)


def test_very_long_texts_and_very_many_spans(spark):
    mails = [f"u{k}@b.co" for k in range(5000)]
    texts = ["x" * 10**6 + "@", "7" * 10**6 + ".", "a." * 200_000, "1." * 20_000, " ".join(mails)]
    docs = documents(spark, texts)
    rows = find_spans(docs).orderBy("doc_id").collect()
    assert [base(r) for r in rows[:3]] == [[]] * 3
    assert base(rows[3]) == [("ip", 8 * k, 8 * k + 7) for k in range(5000)]
    assert [s.value for s in rows[4].base] == mails
    assert redact(docs).orderBy("doc_id").collect()[4].text == " ".join(["<email>"] * 5000)


def test_tokens_in_a_frame_of_their_own_are_found(spark):
    """No seed stands beside them: their many digits lead there, and from them the frame to one with few digits."""
    numbers = [f"{4000 + 7 * k}00001111{k:03d}{check}" for k in range(30) for check in range(10)]
    cards = [c for c in numbers if valid("card", c)]
    assert len(cards) == 30
    texts = [f"w{k} paid {chr(97 + k % 26)}x {c} {chr(97 + k % 26)}y today" for k, c in enumerate(cards)]
    tokens = [f"{k}a1b2c3d4e5f6071829303132{k}" for k in range(4)]
    texts += [f'z{k} token = "{t}" v{k}' for k, t in enumerate(tokens)] + ["in 2024 and 1999 there were 1250 of them"]
    found = [s.value for r in find_spans(documents(spark, texts)).collect() for s in r.spans if s.kind == "id"]
    assert sorted(found) == sorted(tokens)


def scored_by_hand(seen, rounds):
    """Trust of every pattern after some rounds, and its numbers of instances and seeds."""
    edges = {}
    for pattern, instance, seed in seen:
        edges[pattern, instance] = edges.get((pattern, instance), False) or seed
    seeds = {i for (_, i), seed in edges.items() if seed}
    score = {i: float(i in seeds) for _, i in edges}
    for _ in range(rounds):
        members = {p: [i for q, i in edges if q == p] for p, _ in edges}
        trust = {p: sum(score[i] for i in m) / (len(m) + DOUBT) for p, m in members.items()}
        for i in score:
            wrong = math.prod(1 - trust[p] for p, j in edges if j == i)
            score[i] = 1.0 if i in seeds else 1 - wrong
    return {p: (t, len(members[p]), sum(edges[p, i] for i in members[p])) for p, t in trust.items()}


@pytest.mark.parametrize("rounds", [1, 2, 4])
def test_the_scored_graph(spark, rounds):
    rng = random.Random(rounds)
    seeds = {f"i{k}": k % 3 != 0 for k in range(40)}
    seen = []
    for k in range(60):
        of = rng.sample(sorted(seeds), rng.randint(1, 12)) if k % 2 else [i for i in seeds if seeds[i]][: rng.randint(3, 20)] + [f"i{k % 9 * 3}"]
        seen += [(f"p{k}", i, seeds[i]) for i in of for _ in range(rng.randint(1, 3))]
    want = scored_by_hand(seen, rounds)
    trusted = {p: 2 * s >= n for p, (t, n, s) in want.items() if t >= TRUSTED and n >= LEAST_INSTANCES}
    frame = spark.createDataFrame(seen, "pattern string, instance string, seed boolean")
    assert {r.pattern: r.known for r in trusted_patterns(frame, rounds).collect()} == trusted
    assert 0 < len(trusted) < 60


def test_redaction(spark):
    texts = ["write to a@b.co now", None, "+1 (243) 555-5526", "é 10.0.0.1 and 10.0.0.2.", "nothing", "10.0.0.1@x.com", ""]
    rows = redact(documents(spark, texts)).orderBy("doc_id").collect()
    want = ["write to <email> now", None, "<phone>", "é <ip> and <ip>.", "nothing", "<email>", ""]
    assert [r.text for r in rows] == want
    assert [r.n_chars for r in rows] == [None if t is None else len(t) for t in want]


@pytest.mark.parametrize("work", [find_spans, redact])
def test_odd_rows(spark, work):
    docs = odd_documents(spark)
    assert work(docs).count() == 10
    assert work(no_documents(spark)).count() == 0
    if work is redact:
        assert work(docs).columns == docs.columns
        assert sorted(work(docs).collect(), key=repr) == sorted(docs.collect(), key=repr)


def test_plan_is_native(spark, small):
    plan = op7_personal_data(spark, small)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert KINDS == [*FORMS, "id"]
