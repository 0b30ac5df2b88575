from __future__ import annotations

import random
import re

SPACE = " \t\n\x0b\x0c\r"
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id long, _copy string, value string, keep int, n int, block long, c0 int"


def words_of(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def prose(seed: int, count: int, vocabulary: int = 400) -> list[str]:
    rnd = random.Random(seed)
    return [f"w{rnd.randrange(vocabulary)}" for _ in range(count)]


ODD_TEXTS = [
    None,
    "",
    " \n\t ",
    "one",
    "two words",
    "\n\n\n",
    "a\x0bb\x0cc\rd",
    "Größe naïve 漢字   wide",
    "x" * 5000,
    "word " * 3000,
    "\x00 null \x1c byte",
]
