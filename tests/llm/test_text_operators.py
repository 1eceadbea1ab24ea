"""Token counts, secrets and chat formatting against plain references."""

from __future__ import annotations

import hashlib
import random
import re

import pyarrow as pa
import pytest

from sparkmart.llm import automata, chat_format, secret_scan, text_bytes, token_counts

from . import frames

public_tokenizers = pytest.importorskip("public_tokenizers")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def strings(parts, n, longest, seed=1):
    rng = random.Random(seed)
    return [
        "".join(rng.choice(parts) for _ in range(rng.randint(0, longest))) for _ in range(n)
    ]


def test_token_counts_are_the_librarys():
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    counts = token_counts._Counts(token_counts.read_vocabulary(MODEL))
    parts = "  |▁|a|th|the|ing|\n|\t|é|日|😀|<s>|</s>|<0x0A>|0|==|\x00|²|.|_|(|A|　"
    for text in strings([*parts.split("|"), "|"], 5000, 25):
        assert token_counts.count_text(text, counts) == len(library.encode(text)), text


def test_long_word_without_a_space():
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    counts = token_counts._Counts(token_counts.read_vocabulary(MODEL))
    text = "abcab" * 8000
    assert token_counts.count_text(text, counts) == len(library.encode(text))


def test_token_counts_of_odd_documents(spark):
    docs = frames.odd_documents(spark)
    found = token_counts.token_counts(frames.clashing(docs), MODEL, limit=10)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    got = frames.rows(found)
    assert len(got) == 12
    assert (1, 0, 0, False) in got and (2, 0, 0, False) in got
    assert sum(r[3] for r in got) >= 1
    assert token_counts.token_counts(docs.limit(0), MODEL).count() == 0


ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)


def base_spans(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    for k, pattern, least in ((1, "AKIA[A-Z0-9]+", 16), (2, "[0-9a-f]+", 32)):
        found += [
            (m.start(), k, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least
        ]
    return sorted(found)


def test_secrets_are_those_of_the_expressions():
    parts = (
        "token|password|Secret|api_key|APIKEY|=|:| |\"|'|abc|0123456789abcdef|AKIA|XYZ12345|é|"
        "日本|aaaaaaaa|tok|pass|-|_|/|\n"
    ).split("|") + ["0" * 31, "f"]
    texts = strings(parts, 8000, 22, seed=3)
    scan = secret_scan._Scan(secret_scan.BASE)
    got = [[] for _ in texts]
    for block in text_bytes.blocks(pa.array(texts), 1 << 14):
        for row, due in scan.candidates(block).items():
            data = block.data[block.offsets[row] : block.offsets[row + 1]].tobytes()
            got[block.first + row] = scan.spans(data, due)
    assert got == [base_spans(t) for t in texts]
    assert sum(map(bool, got)) > 500


@pytest.mark.parametrize("pattern", ["a(b|cd)*e?", "[^a-y]{2,4}z", "(ab?){1,2}c+", "x*"])
def test_automaton_equals_re(pattern):
    made = automata.compile_rules([pattern])
    for text in strings(list("abcdexyz"), 2000, 9):
        best = max(
            (k for k in range(len(text) + 1) if re.fullmatch(pattern, text[:k])), default=-1
        )
        assert automata.longest(made, text.encode(), 0) == best


def test_secrets_of_odd_documents(spark):
    docs = frames.odd_documents(spark)
    found = secret_scan.find_secrets(frames.clashing(docs))
    assert found.count() == 12 and found.where("size(secrets) > 0").count() == 0
    assert secret_scan.find_secrets(docs.limit(0)).count() == 0


def test_masked_texts(spark):
    text = 'é token = "0123456789abcdef0123456789abcdef" end'
    docs = frames.documents(spark, [(1, text, "en", "a"), (2, "clean", "en", "a"), (3, None, None, None)])
    got = {r.doc_id: r for r in secret_scan.mask_secrets(docs).collect()}
    assert got[1].text == 'é [SECRET]" end' and got[1].n_chars == len(got[1].text)
    assert got[2].text == "clean" and got[3].text is None
    same = secret_scan.mask_secrets(frames.clashing(docs))
    assert same.columns == frames.clashing(docs).columns


def test_turns_are_read_back():
    parts = "<;|;\\;<|;|>;im_end;<|im_end|>;<|im_start|>;\n;a;<|nl|>;é;<\\|".split(";")
    for role, text in zip(strings(parts, 8000, 5), strings(parts, 8000, 12, 2), strict=True):
        written, start, end = chat_format.write_turn(role, text)
        turns = chat_format.parse(written + written)
        assert [(t[0], t[3]) for t in turns] == [(role, text)] * 2
        assert chat_format.unescape(written[start:end]) == text


def test_plain_turns_stay_as_they_are():
    assert chat_format.write_turn("user", "a <| b") == (
        "<|im_start|>user\na <| b<|im_end|>\n",
        17,
        23,
    )


def test_chats_with_nulls_and_ties(spark):
    schema = "conv_id long, turn long, role string, text string, formatted string"
    turns = spark.createDataFrame(
        [
            (1, 1, "assistant", "two", "x"),
            (1, 0, "user", None, "x"),
            (1, 1, "assistant", "two", "x"),
            (2, None, None, "<|im_end|>", "x"),
            (None, 0, "assistant", "", "x"),
        ],
        schema,
    )
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.format_turns(turns)).collect()}
    plain = "user\n\n" + "assistant\ntwo\n" * 2
    assert got[1].turns_sha256 == hashlib.sha256(plain.encode()).hexdigest()
    assert (got[1].n_turns, got[1].loss_chars) == (3, 6)
    assert got[1].loss_sha256 == hashlib.sha256(b"twotwo").hexdigest()
    assert (got[2].n_turns, got[2].loss_chars) == (1, 0) and got[None].n_turns == 1
    empty = chat_format.read_back(chat_format.format_turns(turns.limit(0)))
    assert empty.count() == 0


def test_no_control_string_is_left():
    """Of any template, in roles and in texts; whatever is escaped already comes back too."""
    parts = ["<|im_start|>", "<|nl|>", "<|endoftext|>", "<|", "|>", "<\\|", "<\\\\|x", "\n", "<", "|", "a"]
    for role in ["user", "<|im_start|>user", "a<|nl|>b", "a\nb", "<\\|nl|>", "\n<|im_end|>\n"]:
        for first in parts:
            for second in parts:
                text = first + second
                written, start, end = chat_format.write_turn(role, text)
                assert chat_format.parse(written) == [(role, start, end, text)]
                assert chat_format.unescape(written[start:end]) == text
                assert not re.search(r"<\|[^|]*\|>", written[start:end])
                head = written[len(chat_format.START) : start - 1]
                assert not re.search(r"<\|[^|]*\|>", head.replace(chat_format.NEWLINE, ""))
                assert head.count(chat_format.NEWLINE) == role.count("\n")
