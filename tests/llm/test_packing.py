import json
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shardstream.llm.packing import PLAIN, Recent, cut_documents, encoder, pack_documents, plan_slots
from shardstream.llm.queries import op8_best_fit_packing
from tests.llm.data import documents, no_documents, odd_documents

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(FILE)


def ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def check(rows, wanted, size):
    """Pieces are those of the ids, and sequences are gapless."""
    places, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
    for spans in places.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= size
    assert sorted(by_doc) == sorted(wanted)
    for key, parts in by_doc.items():
        parts.sort(key=lambda r: r.piece)
        assert [p.start for p in parts] == list(range(0, len(wanted[key]), size))
        for p in parts:
            part = np.array(wanted[key][p.start : p.start + size], "<u4")
            assert (p.length, p.ids_crc32) == (len(part), zlib.crc32(part.tobytes()))
    return len(places)


def test_all_documents(spark, small, tokenizer):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    wanted = {r.doc_id: ids(tokenizer, r.text) for r in docs}
    used = check(op8_best_fit_packing(spark, small).collect(), wanted, 4096)
    assert used <= 1.02 * sum(map(len, wanted.values())) / 4096 + 1


def test_words_looked_up_equal_the_tokenizer(tokenizer):
    words, rng = encoder(open(FILE, encoding="utf-8").read()), random.Random(7)
    assert words.by_words
    alphabets = ["aAbB 'stmdrevl", "0123 .!?", "éèßÀÖ÷×µ ", "<|endoftext|> a", "日本 ﬁİς", "\t\n\x0b\x1c\x85\xa0 x", "!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~\x7f\x00"]
    texts = ["".join(rng.choice(rng.choice(alphabets) if k % 3 else alphabets[k % 7]) for _ in range(rng.randint(0, 80))) for k in range(2000)]
    assert 100 < sum(bool(PLAIN.fullmatch(t)) for t in texts) < 1900
    for text in texts:
        assert np.frombuffer(words.ids(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("change", [None, "normalizer", "pre_tokenizer"])
def test_other_vocabularies_are_not_cut_into_words(spark, tmp_path, change):
    file = public_tokenizers.path("byte_bpe_50k.json")
    if change:
        rules = json.loads(open(FILE, encoding="utf-8").read())
        rules[change] = {"normalizer": {"type": "NFC"}, "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}}[change]
        file = str(tmp_path / "rules.json")
        (tmp_path / "rules.json").write_text(json.dumps(rules), encoding="utf-8")
    texts = ["Hello World 123", "it's  Two\n\nlines", "", None, "Ärger über 7 Häuser"]
    other = Tokenizer.from_file(file)
    rows = pack_documents(documents(spark, texts), file).collect()
    check(rows, {k: ids(other, t) for k, t in enumerate(texts)}, 4096)


def test_a_full_table_keeps_what_is_used_again():
    made = []
    table = Recent(lambda key: made.append(key) or key * 2, 3)
    for key in [0, 1, 2, 0, 3, 0, 4, 0, 5, 0, 6, 0]:
        assert table[key] == key * 2
        assert len(table) <= 3 and len(table.former) <= 3
    assert made == [0, 1, 2, 3, 4, 5, 6]


def test_a_word_is_held_once():
    words = encoder(open(FILE, encoding="utf-8").read())
    text = "one two, it's one two one's !'' ''s 7 77"
    assert words.ids(text) == np.array(ids(words.tokenizer, text)[:-1], "<u4").tobytes()
    held = [key for table in vars(words).values() if isinstance(table, Recent) for key in table]
    assert len(held) == len(set(held)) and {"one", "two", "two,", ",", "'s", "77", "7"} <= set(held)


def plain_best_fit(lengths, size):
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= length]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - length)
        else:
            rooms.append(size - length)
    return len(rooms)


def test_the_plan_is_that_of_best_fit_over_documents():
    rng = random.Random(2)
    for size in (10, 64):
        for _ in range(40):
            lengths = [rng.randint(1, size) if rng.random() < 0.6 else rng.randint(1, size // 4) for _ in range(rng.randint(1, 200))]
            rows, sequences = plan_slots(Counter(lengths).items(), size)
            assert sequences == plain_best_fit(lengths, size)
            filled, ranks = defaultdict(list), defaultdict(set)
            for k, (length, first, each, sequence, offset) in enumerate(rows.tolist()):
                until = next((r[1] for r in rows.tolist()[k + 1 :] if r[0] == length), Counter(lengths)[length])
                for rank in range(first, until):
                    ranks[length].add(rank)
                    n = rank - first
                    filled[sequence + n // each].append((offset + n % each * length, length))
            assert {k: len(v) for k, v in ranks.items()} == Counter(lengths)
            assert len(filled) == sequences
            for spans in filled.values():
                ends = [0, *(o + n for o, n in sorted(spans))]
                assert [o for o, _ in sorted(spans)] == ends[:-1] and ends[-1] <= size


def test_small_sequences_and_ids(spark, tokenizer):
    texts = ["word " * n for n in (0, 1, 7, 8, 9, 15, 16, 17, 40)] + [None]
    docs = documents(spark, texts)
    check(pack_documents(docs, FILE, size=8).collect(), {k: ids(tokenizer, t) for k, t in enumerate(texts)}, 8)
    cut = cut_documents(docs, FILE, size=8, with_ids=True).orderBy("doc_id", "piece").collect()
    for k, text in enumerate(texts):
        assert [x for r in cut if r.doc_id == k for x in r.ids] == ids(tokenizer, text)


def test_odd_rows(spark):
    rows = pack_documents(odd_documents(spark), FILE).collect()
    assert len([r for r in rows if r.doc_id in (1, 2, 4) or r.doc_id is None and r.length == 1]) == 4
    assert len([r for r in rows if r.doc_id == 0]) == 2
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    assert pack_documents(no_documents(spark), FILE).count() == 0
