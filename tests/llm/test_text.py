"""Personal data, decontamination, quality, token counts and mixing."""

import hashlib
import os
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from cases import odd_rows
from pyspark.sql import functions as F

from tidewatch.llm import decontamination, mixing, pii, quality, token_counts

BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text):
    found = []
    for k, (kind, expression) in enumerate(BASE):
        for m in re.finditer(expression, text or "", re.ASCII):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15,
            }
            if good[kind]:
                found.append((m.start(), k, m.end()))
    return sorted(found)


def joined(spans):
    return ",".join(f"{BASE[k][0]}:{a}:{b}" for a, k, b in spans)


PERSONAL = [
    "mail a.b%c@d-e.f.gh_i@j.k and @no a@b a@b. x@y.z.",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.255 1.2.3 999999999999999999999999.1.1.1 1..2.3.4",
    "4111 1111 1111 1111, 4111-1111-1111-1112 5500000000000004 12345678901 0000000000000000000 00000000000000000000",
    "+1 (017) 555-7713 +123 +1234567890123456 +(1) +49 30.123456 ++31 20 1234567-",
    "é🙂 é@x.y a+b@c.d 🙂+44 20 7946 0958",
    "card 4111111111111111 ip 10.0.0.1 " * 300,
    "1" * 3000 + " " + "a" * 3000 + " " + "1." * 1000 + "+" + "0 " * 500,
]


def test_base_spans_equal_the_expressions(docs_of):
    rows = [*enumerate(PERSONAL, 50), *[(r[0], r[1]) for r in odd_rows()]]
    found = pii.find(docs_of(rows, "rid hits kind")).collect()
    want = sorted(
        (str(i), *[sum(k == n for _, k, _ in base_spans(t)) for n in range(4)],
         hashlib.sha256(joined(base_spans(t)).encode()).hexdigest()) for i, t in rows
    )
    got = sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in found)
    assert got == want
    texts = dict(rows)
    for r in found:
        spans = set(filter(None, r.spans.split(",")))
        assert set(filter(None, joined(base_spans(texts[r.doc_id])).split(","))) <= spans
    assert pii.find(docs_of([])).count() == 0


def test_contexts_find_unseen_identifiers(docs_of):
    cards = ["4111111111111111", "5500000000000004", "340000000000009", "30000000000004", "6011000000000004", "4012888888881881"]
    rows = [(i, f"please charge card {c} for the order") for i, c in enumerate(cards)]
    rows += [(20, "please charge card 4111-111-111-11 for the order"), (21, "room 4712-111-111-11 in the hotel"),
             (22, "please charge card tomorrow for the order")]
    found = {r.doc_id: r.spans for r in pii.find(docs_of(rows)).collect()}
    assert found[20] == "card:19:34" and found[21] == "" and found[22] == ""
    assert all(found[i] == f"card:19:{19 + len(c)}" for i, c in enumerate(cards))


def test_redaction_replaces_stretches(docs_of):
    rows = [(1, "é mail a@b.c now"), (2, None), (3, "10.0.0.1"), (4, "+1 (017) 555-7713 and 4111 1111 1111 1111!"),
            (None, "ip 10.0.0.1 ip 10.0.0.2"), (5, "")]
    docs = docs_of(rows)
    found = pii.redact(docs)
    assert found.dtypes == docs.dtypes
    got = {r.doc_id: (r.text, r.n_chars, r.lang) for r in found.collect()}
    assert got == {
        1: ("é mail [EMAIL] now", 18, "en"), 2: (None, None, "en"), 3: ("[IP]", 4, "en"),
        4: ("[PHONE] and [CARD]!", 19, "en"), None: ("ip [IP] ip [IP]", 15, "en"), 5: ("", 0, "en"),
    }


ITEMS = "item_id bigint, text string"
QUESTION = "A train leaves the old station with Maria and travels 120 km before noon. How far does Maria go in 3 hours?"


def leaks(spark, docs, items):
    found = decontamination.contaminated(docs, spark.createDataFrame(items, ITEMS)).collect()
    return {(r.doc_id, r.item_id, r.reparameterised) for r in found}


def test_leaks_whole_shouted_and_with_other_parameters(spark, docs_of):
    other = QUESTION.replace("Maria", "Peter").replace("120 km", "95 miles").replace("3 hours", "7 days")
    rows = [
        (1, "So it says. " + QUESTION + " Well."), (2, QUESTION.upper()), (3, other), (4, other.replace("does Peter", "does Klaus")),
        (5, "###".join(QUESTION.split(" ")).replace("###", "*** ")), (6, " ".join(QUESTION.split()[:9])), (None, QUESTION),
        (7, "Nothing of the kind is in this text, which has a train and a station."), (8, None), (9, ""),
    ]
    found = leaks(spark, docs_of(rows, "place item_id line"), [(70, QUESTION), (71, None), (72, ""), (72, ""), (None, "..."), (73, "Short one")])
    assert found == {(1, 70, False), (2, 70, False), (3, 70, True), (5, 70, False), (None, 70, False)}
    assert leaks(spark, docs_of([]), [(1, QUESTION)]) == set() == leaks(spark, docs_of(rows), [])


def test_one_inconsistent_slot_leaves_the_other_windows(spark, docs_of):
    item = ("a lorry drives 60 km in 2 hours on the first day of its long way to the north coast "
            "and then another 60 km in 3 hours on the last day before it stops there")  # fmt: skip
    fruit = "she buys 3 apples and 5 pears at the market and brings all of them home"
    rows = [(1, item.replace("60", "65", 1)), (2, fruit.replace("3", "4").replace("5", "4")), (3, item.replace("60", "65"))]
    assert leaks(spark, docs_of(rows), [(7, item), (8, fruit)]) == {(1, 7, False), (2, 8, True), (3, 7, True)}


def test_short_items_match_whole(spark, docs_of):
    rows = [(1, "they ask: What is the capital of France? Now."), (2, "What is the capital city of France")]
    assert leaks(spark, docs_of(rows), [(5, "What is the capital of France?")]) == {(1, 5, False)}


def test_without_keeps_clean_rows(spark, docs_of):
    docs = docs_of([(1, QUESTION), (None, QUESTION), (2, "clean"), (None, None), (3, "")])
    kept = decontamination.without(docs, spark.createDataFrame([(1, QUESTION)], ITEMS))
    assert kept.columns == docs.columns and sorted(map(str, [r.doc_id for r in kept.collect()])) == ["2", "3", "None"]


# --- quality ---------------------------------------------------------------------------


def labelled(n=240):
    draw = random.Random(1)
    word = lambda: "".join(draw.choice(("th", "er", "an", "ou", "st")) for _ in range(draw.randint(1, 4)))
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        rows.append((i, " ".join(word() + (draw.choice(("$$$", "&&&", "!!")) if bad else "") for _ in range(draw.randint(5, 200)))))
        labels.append((i, int(not bad), i % 2))
    return rows, labels


LABELS = "doc_id bigint, quality int, toxic int"


def test_quality_on_held_out_documents(spark, docs_of):
    rows, labels = labelled()
    wrong = [(i, 1 - q, t) if zlib.crc32(str(i).encode()) % 5 == 0 else (i, q, t) for i, q, t in labels]
    docs = docs_of(rows, "score predicted")
    net = quality.train(docs, spark.createDataFrame(labels, LABELS))
    same = quality.train(docs, spark.createDataFrame(wrong, LABELS))
    assert all((a == b).all() for a, b in zip(net.values(), same.values(), strict=True)), "held-out labels were used"
    found = quality.score(docs, net).select("doc_id", quality.held_out(F.col("doc_id")).alias("h"), "score", "predicted").collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    assert np.mean([(r.score >= 0.5) == (r.doc_id % 4 != 0) for r in found if r.h]) >= 0.95


def test_quality_of_odd_rows(spark, docs_of):
    rows, labels = labelled(40)
    odd = odd_rows()
    net = quality.train(docs_of(rows), spark.createDataFrame([*labels, (None, 1, 0), (3, None, 0), (3, 7, 0), (999, 1, 0)], LABELS))
    found = quality.score(docs_of(odd), net).collect()
    assert len(found) == len(odd) and all(0 <= r.score <= 1 for r in found)
    assert quality.score(docs_of([]), net).count() == 0
    untaught = quality.train(docs_of(rows), spark.createDataFrame([], LABELS))
    assert {r.score for r in quality.score(docs_of(odd), untaught).collect()} == {0.5}


def test_windows_cover_the_text_and_blocks_do_not_matter(monkeypatch):
    net = quality.Network.fresh()
    net.weights += np.random.default_rng(0).normal(size=net.weights.shape).astype(np.float32)
    texts = pa.array(["", None, "x", "a" * 15, "b" * 16, "c" * 17, "some words " * 700, "é" * 999])
    whole = quality.score_texts(net, texts)
    for part in quality.slices(texts, 1 << 40):
        w = quality.Windows.of(part)
        seen = np.zeros(len(part.data), bool)
        for s, e in zip(w.start, w.end, strict=True):
            seen[s : min(e, s + quality.WIDTH)] = True
        assert seen.all()
    monkeypatch.setattr(quality, "BLOCK", 7)
    assert np.allclose(quality.score_texts(net, texts), whole)


def test_gradients_are_slopes():
    texts = ["abc def ghi jkl mno pqr", "some other text that is rather longer " * 30, ""]
    net, label = quality.Network.fresh(0.3), np.array([1, 0, 1])
    net.weights += 0.1
    (part,) = quality.slices(pa.array(texts), 1 << 40)

    def loss():
        odds = np.log(s := quality.score_texts(net, pa.array(texts))) - np.log(1 - s)
        return np.mean(np.log1p(np.exp(odds)) - label * odds)

    for value, slope in zip(net.values(), quality._gradients(net, part, label), strict=True):
        at = np.unravel_index(np.abs(slope).argmax(), slope.shape)
        value[at] += 1e-3
        up = loss()
        value[at] -= 2e-3
        down = loss()
        value[at] += 1e-3
        assert (up - down) / 2e-3 == pytest.approx(slope[at], rel=0.1)


# --- token counts ----------------------------------------------------------------------

TEXTS = [
    "", " ", "  a  b", "日本語 text\n\n new", "<s> a </s> <0x0A>", "▁x▁▁y", "aaaaaaaaaaaaaa", "\tq", "é́🙂🙂", "\x00\x01 abc",
    "naïve 🙂x🙂", "The quick brown fox, in 1999, unbelievably jumped.", "x" * 5000 + "🙂" * 50,
]


def reference(pieces, fallback):
    tokenizers = pytest.importorskip("tokenizers")
    found = tokenizers.Tokenizer(tokenizers.models.Unigram(pieces, unk_id=0, byte_fallback=fallback))
    found.pre_tokenizer = tokenizers.pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return lambda text: len(found.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("fallback", [True, False])
def test_counts_equal_the_tokenizer(fallback):
    from tidewatch.llm.queries import TOKENIZER

    pieces = [p for p in token_counts.vocabulary(TOKENIZER) if fallback or not p[0].startswith("<0x")]
    count, want = token_counts.Counter(pieces), reference(pieces, fallback)
    assert [count.text(t) for t in TEXTS] == [want(t) for t in TEXTS]


def test_ties_and_unknowns_equal_the_tokenizer():
    draw = random.Random(4)
    for _ in range(60):
        names = {"".join(draw.choice("ab▁") for _ in range(draw.randint(1, 4))) for _ in range(8)}
        pieces = [("<unk>", 0.0), *[(n, -float(draw.randint(1, 3))) for n in sorted(names)]]
        count, want = token_counts.Counter(pieces), reference(pieces, False)
        for _ in range(20):
            text = "".join(draw.choice("aabb cz") for _ in range(draw.randint(0, 12)))
            assert count.text(text) == want(text), (pieces, text)


def test_token_table(spark, docs_of, monkeypatch):
    monkeypatch.setattr(token_counts, "KNOWN", 2)
    pieces = [("<unk>", 0.0), ("▁", -3.0), ("a", -2.0), ("▁a", -1.5), ("b", -2.0)]
    rows = [(1, "a b a b"), (2, None), (3, ""), (None, "ab"), (4, "zz b"), (4, "zz b")]
    want = reference(pieces, False)
    found = token_counts.count_tokens(docs_of(rows, "n_tokens"), pieces).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r.doc_id, r.n_tokens) for r in found), key=key) == sorted(((i, want(t or "")) for i, t in rows), key=key)
    assert token_counts.count_tokens(docs_of([]), pieces).count() == 0


# --- mixing ----------------------------------------------------------------------------


def filled(sizes):
    """Targets by resharing what exceeds a source's limit until nothing does."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, full, share = 1.5 * sum(sizes.values()), set(), {}
    while True:
        rest = [s for s in names if s not in full]
        total = left - sum(2 * sizes[s] for s in full)
        share = {s: total * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = {s for s in rest if share[s] > 2 * sizes[s]}
        if not over:
            return share | {s: 2.0 * sizes[s] for s in full}
        full |= over


def words_of(n):
    return " ".join(["word"] * n)


@pytest.mark.parametrize("block, shard", [(256, 4096), (4, 10)])
def test_mix_meets_targets(docs_of, monkeypatch, block, shard):
    monkeypatch.setattr(mixing, "BLOCK", block)
    monkeypatch.setattr(mixing, "SHARD", shard)
    draw = random.Random(2)
    rows = [(i, words_of(draw.randint(0, 60)), draw.choice(["b", "a", "Z", "é", None, "aa"])) for i in range(300)]
    rows += [(500, words_of(5000), "a"), (501, words_of(1), "tiny"), (502, None, "none"), (503, "", "b"), (None, words_of(9), "b"),
             (504, "\n\t ", None), (7, words_of(3), "a"), (7, words_of(3), "a")]
    docs = docs_of(rows, "size rid start block")
    found = mixing.mix(docs).collect()
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    want = filled(sizes)
    assert len(found) == len(rows)
    by_target = {}
    for r in found:
        assert 0 <= r.taken <= 2 * r.size
        key = (r.source_size, round(r.target, 6))
        by_target[key] = by_target.get(key, 0) + r.taken
    expected = {}
    for s, t in want.items():
        expected[(sizes[s], round(t, 6))] = expected.get((sizes[s], round(t, 6)), 0) + round(t)
    assert set(by_target) == set(expected)
    assert all(abs(by_target[k] - expected[k]) <= 1 for k in expected)
    again = mixing.mix(docs.repartition(2)).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))


def test_mix_is_written_with_its_words(docs_of, monkeypatch, tmp_path):
    monkeypatch.setattr(mixing, "BLOCK", 4)
    monkeypatch.setattr(mixing, "SHARD", 10)
    draw = random.Random(8)
    rows = [(i, "\n ".join(f"{i}.{k}" for k in range(draw.randint(0, 30))), draw.choice(["a", "b", None])) for i in range(60)]
    rows += [(3, "3.0 3.1 3.2 3.3 3.4", "a")] * 2 + [(None, "x.0 x.1", "b"), (70, None, "a")]
    docs, out = docs_of(rows, "words parts shard"), str(tmp_path / "mix")
    found = sorted(mixing.mixture(docs, out).collect(), key=str)
    assert len({r.shard for r in found}) == len(list((tmp_path / "mix").glob("shard=*"))) > 5
    blocks, taken = {}, {}
    for r in found:
        words = r.words.split(" ")
        assert len(words) == sum(p.n for p in r.parts) <= 4
        blocks.setdefault((r.source, r.block), set()).add(r.words)
        for p in r.parts:
            own, words = words[: p.n], words[p.n :]
            name, first = own[0].split(".")
            assert own == [f"{name}.{int(first) + k}" for k in range(p.n)] and name == ("x" if p.doc_id is None else str(p.doc_id))
            taken[p.doc_id] = taken.get(p.doc_id, 0) + p.n
    # a block is the same in all its slots, but for the last slot, which may be cut
    assert all(max(some, key=len).startswith(x) for some in blocks.values() for x in some)
    slots = [(r.source, r.slot) for r in found]
    assert len(set(slots)) == len(slots)
    counts = {}
    for r in mixing.mix(docs).collect():
        counts[r.doc_id] = counts.get(r.doc_id, 0) + r.taken
    assert {i: n for i, n in counts.items() if n} == taken
    monkeypatch.setattr(mixing, "SEED", mixing.SEED + 1)
    assert sorted(mixing.mixture(docs).collect(), key=str) != found


def test_permutation_is_one(spark):
    from pyspark.sql import functions as F

    for n in (1, 2, 3, 7, 16, 97, 1000):
        df = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("bigint"), F.lit(5), F.lit("s")).alias("p"))
        places = [r.p for r in df.collect()]
        assert sorted(places) == list(range(n)) and (n < 97 or places != sorted(places))


def test_nothing_to_mix(docs_of):
    assert mixing.mix(docs_of([])).count() == 0
    assert [tuple(r)[1:] for r in mixing.mix(docs_of([(1, None), (2, "")])).collect()] == [(0, 0, 0.0, 0)] * 2


def test_mix_goes_to_its_shards_in_turns(docs_of, monkeypatch, tmp_path):
    """The disk must not hold all cut words, their shuffle and the mix at the same time."""
    monkeypatch.setattr(mixing, "BLOCK", 4)
    monkeypatch.setattr(mixing, "SHARD", 10)
    docs = docs_of([(i, " ".join(f"{i}.{k}" for k in range(20)), "ab"[i % 2]) for i in range(40)])
    seen, drop = [], mixing.drop_folder

    def dropping(spark, folder):
        seen.append({s.name for s in (tmp_path / "mix").glob("shard=*")})
        drop(spark, folder)
        assert not os.path.exists(folder.removeprefix("file:"))

    monkeypatch.setattr(mixing, "drop_folder", dropping)
    found = mixing.mixture(docs, str(tmp_path / "mix")).collect()
    assert len(seen) == mixing.TURNS and all(a < b for a, b in zip(seen, seen[1:]))
    assert seen[-1] == {f"shard={r.shard}" for r in found}
    assert sum(len(r.words.split()) for r in found) == 1200
