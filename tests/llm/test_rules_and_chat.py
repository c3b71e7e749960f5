import hashlib
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from surveyloom.llm import catalog, chat, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), sum(map(text.count, "#*$%&|<>")), len(lines) - len(set(lines)), len(covered),
            len(words) < 20 or 100 * len(covered) > 30 * len(words))


def test_base_figures_of_awkward_texts(clashing):
    rows = quality_rules.judge(clashing).collect()
    texts = sorted((base(r["text"]) for r in clashing.collect()))
    assert sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows) == texts
    assert quality_rules.judge(clashing).where("kept").count() == sum(r.kept for r in rows)


def test_lines_are_judged_before_the_document(spark):
    kinds = zip(("foxes", "bakers", "clerks", "smiths", "nurses", "owls"), ("Norway", "Bern", "Lyon", "Cork", "Riga", "Split"), ("hid", "sold", "lost", "made", "found", "drew"), ("bread", "maps", "coins", "bells", "songs", "nets"))
    prose = "\n".join(f"Chapter {i} tells how the {a} of {b} once {c} their {d} before winter came." for i, (a, b, c, d) in enumerate(kinds))
    menu, notice = "Home | News | Sport | Contact | About", "Licensed under the Apache License, Version 2.0."
    docs = spark.createDataFrame([(1, prose), (2, prose + "\n" + menu + "\n" + notice), (3, "\n".join([menu] * 1 + [f"a{i} | b{i} | c{i} | d{i}" for i in range(9)])), (4, "GO" + "!! GO" * 40)], "doc_id long, text string")
    found = {r.doc_id: r for r in quality_rules.judge(docs).collect()}
    assert found[1].kept and found[1].cleaned == prose
    assert found[2].kept and found[2].cleaned == prose and found[2].n_removed_lines == 2
    assert not found[3].kept and not found[4].kept


def test_rules_of_no_documents(no_docs):
    assert quality_rules.judge(no_docs).count() == 0


def test_no_python_in_the_rules(awkward):
    plan = quality_rules.digest(quality_rules.judge(awkward))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


PIECES = st.lists(st.sampled_from(["[INST]", "[/INST]", "</s>", "<s>", "<<SYS:", "<</SYS>>", "\\", " ", ">> ", "a", "\n", "[INST", "/INST]", "😀"]), max_size=8).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "a>b\\c", "User"]), PIECES), max_size=5))
def test_any_turns_come_back(turns):
    assert chat.parse("".join(chat.round_trip(r, t) for r, t in turns)) == turns


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "a>b\\c"]), PIECES), max_size=5), st.lists(st.integers(1, 9), min_size=1, max_size=60))
def test_turns_come_back_from_pieces_of_any_size(turns, sizes):
    whole, reader, found, at = "".join(chat.round_trip(r, t) for r, t in turns), chat.Reader(), [], 0
    while at < len(whole):
        size = sizes[at % len(sizes)]
        found += reader.feed(whole[at:at + size])
        at += size
    assert found + reader.close() == turns


def test_reader_rejects_what_is_no_conversation():
    for text in ("[INST] open", "[INS", "<<SYS:a", "no turn", "[INST] a </s>", "<s> a </s>b"):
        reader = chat.Reader()
        with pytest.raises(chat.GrammarError):
            reader.feed(text)
            reader.close()


def test_a_turn_that_comes_back_otherwise_fails_the_job():
    found = chat._Recovered(1, False)
    with pytest.raises(chat.GrammarError):
        found.add(chat.round_trip("user", "a"), chat.source_digest("user", "b"))


def test_only_conflicting_texts_are_escaped():
    assert chat.round_trip("user", "a \\ b") == "[INST] a \\ b [/INST]"
    assert chat.round_trip("user", "</s>") == "[INST] \\</s> [/INST]"
    with pytest.raises(chat.GrammarError):
        chat.parse("[INST] open")


def test_conversations_with_awkward_rows(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "b"), (1, 1, "assistant", "a"), (1, 1, "assistant", "a"), (None, None, None, "x"), (2, 0, "assistant", catalog.PLANTED), (2, None, "system", "s" * 50000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("rendered", "source", "formatted", "n_turns"):
        turns = turns.withColumn(name, F.lit(7))
    found = {r.conv_id: r for r in chat.conversations(turns).collect()}
    order = {1: [("user", ""), ("assistant", "a"), ("assistant", "a"), ("assistant", "b")], None: [("", "x")], 2: [("system", "s" * 50000), ("assistant", catalog.PLANTED)]}
    assert set(found) == set(order)
    for key, want in order.items():
        r = found[key]
        assert r.n_turns == len(want) and r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in want).encode()).hexdigest()
        loss = "".join(b for a, b in want if a == "assistant")
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.formatted_chars == len(r.formatted) and chat.parse(r.formatted) == want
    assert chat.conversations(turns.limit(0)).count() == 0
