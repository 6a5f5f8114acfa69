"""Fixed values that the file formats and the training side rely on."""

from __future__ import annotations

# The special tokens, in the order that gives them ids 0..4.
SPECIAL_TOKENS = ("<s>", "<pad>", "</s>", "<unk>", "<mask>")
BOS_ID, PAD_ID, EOS_ID, UNK_ID, MASK_ID = range(5)

# Fixed value: positions that neither the loss nor the metrics look at.
IGNORE_LABEL = -100

# Sizes used when the caller gives none.
VOCAB_SIZE = 49_152
MIN_FREQUENCY = 2
DEV_RATIO = 0.01
TEST_FRACTION = 0.1
BATCH_SIZE = 8
MASK_RATE = 0.15
TUNING_MAX_LENGTH = 256

# Entity label ids.
NER_LABELS = {
    "I-LOC": 0,
    "B-PERS": 1,
    "B-EVENT": 2,
    "I-ORG": 3,
    "B-LOC": 4,
    "B-DEMO": 5,
    "I-DEMO": 6,
    "I-PERS": 7,
    "I-WORK": 8,
    "I-ROLE": 9,
    "B-WORK": 10,
    "I-EVENT": 11,
    "B-ROLE": 12,
    "B-ORG": 13,
    "O": 14,
}

# Fixed value: the public GPT-2 piece pattern. (?U) makes \s mean Unicode white space.
PIECE_PATTERN = (
    r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def byte_alphabet() -> list[str]:
    """The visible character that stands for each byte value 0..255.

    Printable bytes stand for themselves; the others take the characters from
    U+0100 on, in byte order.
    """
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]
