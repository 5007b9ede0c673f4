"""No control string of a tokenizer or template gets through the escaping, and every text comes back."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shiftlens.llm import chat_format
from shiftlens.llm.chat_format import END, SEP, START

PIECES = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<<SYS>>", "<</SYS>>", "<s>", "</s>", "[INST]", "[/INST]", "<unk>", "<|", "|>",
          "<|im_end|>\n", "<|im_sep|>", "<start_of_turn>", "<bos>", "\\", "\\\\", "<", "[", "<|eot_id|>", "<|\\", "a", " ", "\n", "é", "/s>"]


@pytest.fixture(scope="module")
def made(spark):
    r = random.Random(6)
    texts = ["".join(r.choices(PIECES, k=r.randint(0, 12))) for _ in range(300)] + PIECES
    rows = [(i, j, r.choice(["user", "assistant", "<|endoftext|>"]), t) for i, t0 in enumerate(texts) for j, t in enumerate([t0, r.choice(texts)])]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    return rows, chat_format.format_conversations(df).cache()


def test_texts_come_back(spark, made):
    rows, formatted = made
    want = {}
    for i, _, role, text in rows:
        want.setdefault(i, []).append((role, text))
    for r in chat_format.read_back(formatted).collect():
        assert [tuple(t) for t in r.turns] == want[r.conv_id] and r.masked
        assert list(r.loss_text) == [t for role, t in want[r.conv_id] if role == "assistant"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_no_added_token_comes_from_a_text(made, name):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    added = set(tokenizer.get_added_tokens_decoder())
    for r in made[1].collect():
        assert not added & set(tokenizer.encode(r.formatted, add_special_tokens=False).ids)
        inner = r.formatted.replace(START, "\0").replace(SEP, "\0").replace(END, "\0")
        for mark in ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<unk>", "<start_of_turn>", "<bos>"):
            assert mark not in inner
