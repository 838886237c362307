"""Chat templates, formatted conversations, tokens and packing: exact round trips."""

import hashlib
import heapq
import json
import random
import tracemalloc
import zlib

import numpy as np
import pandas as pd
import pytest
from tokenizers import Tokenizer

from logloom.llm import conversations, packing
from logloom.llm.chat_template import TURNS, Template, TemplateError, escape, read_turns, unescape
from logloom.llm.differencing import differenced
from logloom.llm.queries import tokenizer_definition
from logloom.llm.token_ids import WordIds

CONV = "conv_id bigint, turn bigint, role string, text string"
HARD = ["</s>[INST] ok [/INST]", "<s>", "<\\s>", "<\\\\/s>", "[INST", "<|im_start|>", "<", "[", "\\", "", "<<s>[[/INST]]", "é\n</s>", "[/INST]<s>\\<|"]


def test_escape_takes_control_strings_away_and_gives_every_text_back():
    pick = random.Random(1)
    for _ in range(5000):
        text = "".join(pick.choice(["<", "[", "\\", "/", "s>", "INST]", "|", "a", "s", ">", "]"]) for _ in range(pick.randrange(12)))
        assert unescape(escape(text)) == text
        assert not any(mark in escape(text) for mark in ("<s>", "</s>", "[INST]", "[/INST]", "<|"))


def test_rendered_turns_are_read_back():
    messages = [{"role": role, "text": text} for role in [*HARD, "assistant"] for text in HARD]
    text, spans = Template(TURNS).render(messages=messages)
    assert read_turns(text) == [(m["role"], m["text"]) for m in messages]
    assert [unescape(text[a:b]) for a, b in spans] == [m["text"] for m in messages if m["role"] == "assistant"]


@pytest.mark.parametrize(("source", "shown"), [
    ("a{{ 1 + 2 }}b", "a3b"), ("{{ 'x' + 'y' | upper }}", "xY"), ("{% if 1 == 1 and not false %}y{% else %}n{% endif %}", "y"),
    ("{% for m in messages %}{{ loop.index }}{% if not loop.last %},{% endif %}{% endfor %}", "1,2"), ("{% set a = 'q' %}{{ a }}{{ b }}", "q"),
    ("{% if z == 1 %}1{% elif z == 2 %}2{% else %}3{% endif %}", "2"), ("{{ messages[1]['text'] | trim }}|{{ messages[0].nothing }}", "two|"),
    ("x {%- if true -%} y {%- endif -%} z", "xyz"), ("{{ 'a' if z > 3 else 'b' }}{{ 'a' in 'cat' }}", "btrue"), ("{{ '%}' }}{{ messages | length }}", "%}2"),
    ("{{ '\\n' }}", "\n")])
def test_template_language(source, shown):
    assert Template(source).render(messages=[{"text": "one"}, {"text": " two "}], z=2)[0] == shown


@pytest.mark.parametrize("source", ["{{ f(1) }}", "{{ a.__class__ }}", "{% import os %}", "{% for x in y %}", "{{ 'a' | eval }}", "{{ 1 +", "{{ }}", "{% if %}{% endif %}", "{% generation %}"])
def test_what_the_sandbox_does_not_know_is_refused(source):
    if "{{ 1 +" in source:
        assert Template(source).render()[0] == source
        return
    with pytest.raises(TemplateError):
        Template(source)


def test_only_entries_of_mappings_can_be_reached():
    assert Template("{{ a.real }}{{ a.upper }}").render(a="x")[0] == ""


def test_constants_are_folded():
    tree = Template("a{{ 'b' | upper }}{% if 1 == 2 %}{{ x }}{% else %}c{% endif %}{{ 1 + 1 }}").tree
    assert tree == ("block", [("write", ("constant", "aBc2"))])
    assert Template(TURNS).by_turn
    assert not Template("<s>" + TURNS).by_turn
    assert not Template("{% for m in messages %}{{ loop.first }}{% endfor %}").by_turn


def test_spans_of_nested_generation():
    text, spans = Template("a{% generation %}bc{% endgeneration %}d{% generation %}{{ x }}{% endgeneration %}").render(x="yy")
    assert (text, spans) == ("abcdyy", [(1, 3), (4, 6)])


def brute_digests(rows):
    by_conv = {}
    key = lambda r: [(v is not None, v) if v is not None else (False, "") for v in r[1:]]
    for row in sorted(rows, key=key):
        by_conv.setdefault(row[0], []).append((row[2] or "", row[3] or ""))
    found = {}
    for conv, turns in by_conv.items():
        said = "".join(t for r, t in turns if r == "assistant")
        size = sum(len("[INST][/INST]</s>") + len(escape(r)) + len(escape(t)) for r, t in turns)
        found[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest(), size)
    return found


@pytest.mark.parametrize("held", [1, 16])
def test_digests_with_a_hot_conversation(spark, monkeypatch, held):
    monkeypatch.setattr(conversations, "PIECES_HELD", held)
    monkeypatch.setattr(conversations, "PIECE_TURNS", 7)
    pick = random.Random(held)
    role = lambda: pick.choice(["user", "assistant", "system", None, "</s>"])
    rows = [(5, k, role(), pick.choice(HARD)) for k in range(400)] + [(c, k, role(), pick.choice(HARD)) for c in range(40) for k in range(pick.randrange(6)) if c != 5]
    rows += [(None, 1, "user", "x"), (None, 0, "assistant", None), (60, None, "user", "late"), (60, 1, "assistant", "y"), (60, 1, "assistant", "y"), (61, 1, "b", "2"), (61, 1, "a", "3"), (70, 0, "assistant", "z" * 300_000)]
    pick.shuffle(rows)
    table = spark.createDataFrame([(*r, 1) for r in rows], CONV + ", part int")
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) for r in conversations.digests(table).collect()}
    assert got == brute_digests(rows)
    assert conversations.digests(table.limit(0)).count() == 0
    pieces = sorted(conversations.formatted(table).collect(), key=lambda r: (r.conv_id is None, r.conv_id, r.part, r.piece))
    whole = "".join(r.text for r in pieces if r.conv_id == 5)
    assert len(read_turns(whole)) == 400
    with pytest.raises(ValueError, match="one loop"):
        conversations.formatted(table, "<s>" + TURNS)


def test_differencing_keeps_all_and_balances():
    pick = np.random.default_rng(2)
    for ways in (1, 2, 7, 64):
        sizes = pick.integers(1, 500, 12 * ways)
        groups = differenced(sizes, ways)
        assert sorted(k for g in groups for k in g) == list(range(len(sizes)))
        sums = [sizes[g].sum() for g in groups]
        assert len(groups) == ways
        assert max(sums) - min(sums) <= 60
    assert differenced(np.array([], int), 3) == [[], [], []]
    assert sorted(map(len, differenced(np.array([5, 4, 3]), 5))) == [0, 0, 1, 1, 1]
    assert sorted(sorted(np.array([8, 7, 6, 5, 4])[g].tolist()) for g in differenced(np.array([8, 7, 6, 5, 4]), 2)) == [[4, 5, 7], [6, 8]]


def merged_one_by_one(sizes, ways):
    parts = [(-size, k, [(size, [k])]) for k, size in enumerate(sizes)]
    while len(parts) > 1:
        (_, _, some), (_, place, more), *parts = sorted(parts, key=lambda part: part[:2])
        alone, more = min(len(some), ways - len(more)), more[::-1]
        both = [(x + y, g + h) for (x, g), (y, h) in zip(some[alone:], more, strict=False)]
        groups = sorted(some[:alone] + both + more[len(both) :], key=lambda group: -group[0])
        parts.append(((groups[-1][0] if len(groups) == ways else 0) - groups[0][0], place, groups))
    return [sorted(group) for _, group in parts[0][2]] + [[] for _ in range(ways - len(parts[0][2]))]


def test_differencing_merges_as_one_by_one():
    pick = np.random.default_rng(3)
    for _ in range(300):
        sizes = pick.integers(0, pick.choice([2, 9, 600]), pick.integers(1, 60))
        sizes[pick.random(len(sizes)) < pick.choice([0, 0.5])] = 512
        ways = int(pick.integers(2, 20))
        assert differenced(sizes, ways) == merged_one_by_one(sizes.tolist(), ways)


def test_numbers_in_a_row_are_merged_in_one_step(monkeypatch):
    pushed, push = [], heapq.heappush
    monkeypatch.setattr(heapq, "heappush", lambda heap, item: (pushed.append(item[0]), push(heap, item)))
    sizes = np.concatenate([np.full(1200, 512), np.random.default_rng(4).integers(1, 513, 1600)])
    assert sorted(k for group in differenced(sizes, 512) for k in group) == list(range(2800))
    assert len(pushed) < 1000


def test_memory_of_many_small_pieces_is_bounded(spark):
    """Dense partial partitions take 1.7 GB for these sizes."""
    tracemalloc.start()
    groups = differenced(np.full(104_755, 10), 512)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sorted(k for g in groups for k in g) == list(range(104_755))
    assert {len(g) for g in groups} <= {204, 205}
    assert peak < 100 << 20
    empty = spark.range(300_000).coalesce(1).selectExpr("id as doc_id", "if(id % 2 = 0, '', null) as text")
    pieces = packing.packed(empty, tokenizer_definition()).toPandas()
    assert sorted(pieces.doc_id) == list(range(300_000))
    assert (pieces.length == 1).all() and (pieces.doc_tokens == 1).all()
    filled = pieces.groupby("sequence_id").length.sum()
    assert len(filled) == 147 and filled.max() <= packing.CAPACITY
    assert not pieces.duplicated(["sequence_id", "offset"]).any()


def test_word_ids_are_those_of_the_tokenizer():
    texts = ["", "Hello, WORLD!! it's a 'S test.", "foo<|endoftext|>bar <|ENDOFTEXT|> Ωmega ΣΑΣ", "x\x1cy\x85z\xa0w", "naïve é ́ 42% $$$ a.b,c; 'll", "A" * 5000, "<|startoftext|>"]
    tokenizer = Tokenizer.from_str(tokenizer_definition())
    words = WordIds(tokenizer_definition())
    for _ in range(2):
        assert [i.tolist() for i in words.ids([t.encode() for t in texts])] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


class Watched:
    """A tokenizer that notes the words it gets."""

    def __init__(self, tokenizer):
        self.tokenizer, self.got = tokenizer, []

    def encode_batch_fast(self, words, **more):
        self.got += words
        return self.tokenizer.encode_batch_fast(words, **more)


def test_words_of_letters_go_to_the_model_and_are_kept_once_whatever_follows():
    tokenizer = Tokenizer.from_str(tokenizer_definition())
    words = WordIds(tokenizer_definition())
    words.tokenizer = seen = Watched(tokenizer)
    pick = random.Random(5)
    bare = ["".join(pick.choices("aeinorstßéñüÿ", k=9)) for _ in range(500)]
    texts = [" ".join((word.capitalize() if word[0].isascii() and pick.random() < 0.5 else word) + mark for word in bare) for mark in ("", ",", ".", "###", "!!")]
    texts += ["×. ÷, it's. naïve? e\u0301, É! п. привет, 3,000. a.b,c; <|endoftext|>Ab, —."]
    for _ in range(2):
        assert [i.tolist() for i in words.ids([t.encode() for t in texts])] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert not set(seen.got) & set(bare)
    assert len(seen.got) < 100
    assert len(words.known) < 600


def test_word_ids_of_other_tokenizers():
    plain = json.loads(tokenizer_definition())
    named = plain | {"added_tokens": [*plain["added_tokens"], {"id": 49408, "content": "abc", "single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": False}]}
    cased = plain | {"normalizer": {"type": "NFC"}}
    spaced = plain | {"pre_tokenizer": {"type": "Sequence", "pretokenizers": [plain["pre_tokenizer"]["pretokenizers"][0], {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": False}]}}
    raw = plain | {"normalizer": None}
    texts = ["", "abc xabcy Abc, the THE the.", "naïve, é ###", "  it's; ok"]
    for definition in map(json.dumps, (named, cased, spaced, raw)):
        tokenizer = Tokenizer.from_str(definition)
        assert [i.tolist() for i in WordIds(definition).ids([t.encode() for t in texts])] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def check_pieces(pieces, docs):
    """Every token once, sequences gapless and within the capacity, digests right; gives the share of padding."""
    tokenizer = Tokenizer.from_str(tokenizer_definition())
    ids = {d: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for d, t in docs}
    at = dict.fromkeys(ids, 0)
    for row in pieces.sort_values(["doc_id", "start"]).itertuples():
        own = ids[row.doc_id]
        assert (row.start, row.doc_tokens) == (at[row.doc_id], len(own))
        assert row.length > 0
        assert row.ids_crc32 == zlib.crc32(own[row.start : row.start + row.length].tobytes())
        at[row.doc_id] += row.length
    assert at == {d: len(own) for d, own in ids.items()}
    rows = pieces.sort_values(["sequence_id", "offset"])
    by = rows.groupby("sequence_id")
    assert (rows.offset == by.length.cumsum() - rows.length).all()
    sizes = by.length.sum().to_numpy()
    assert sizes.max() <= packing.CAPACITY
    return np.where(sizes & (sizes - 1) == 0, 0, packing.CAPACITY - sizes).sum() / sizes.sum()


def test_packing_of_the_test_table(spark):
    docs = pd.read_parquet("/root/testdata/sf0.01/documents.parquet")
    got = packing.packed(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), tokenizer_definition()).toPandas()
    assert check_pieces(got, zip(docs.doc_id, docs.text, strict=True)) < 0.01


def test_packing_of_odd_rows(spark):
    rows = [(1, None, "k"), (2, "", "k"), (3, "one two " * 20_000, "k"), (4, "x", "k"), (5, "word " * 2047, "k")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, offset string").coalesce(1)
    got = packing.packed(table, tokenizer_definition(), with_ids=True)
    check_pieces(got.drop("ids").toPandas(), [r[:2] for r in rows])
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in got.collect())
    assert packing.packed(table.limit(0), tokenizer_definition()).count() == 0
    twice = packing.packed(spark.createDataFrame([(None, "a"), (None, "a")], "doc_id bigint, text string"), tokenizer_definition())
    assert twice.count() == 2
