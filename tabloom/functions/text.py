"""Tokenizing as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters deleted before splitting. The apostrophe is kept.
DELETED_CHARACTERS = '.?!#$%&()*+,-/:;<=>@«»"[\\]^_`{|}~\t\n'
# Characters that separate words.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def lower_case(text: str | Column) -> Column:
    return F.lower(text)


def _split_on_spaces(text: Column) -> Column:
    # a one-character separator needs no regular expression at run time
    return F.array_remove(F.split(text, " "), "")


def tokenize(
    text: str | Column,
    *,
    characters: str = DELETED_CHARACTERS,
    newline_as_space: bool = False,
) -> Column:
    """Lower-case, delete punctuation and split into words.

    Tab and newline are among the deleted characters, so words on both sides of a line
    break fuse. ``newline_as_space`` lets both separate words instead. One pass over the
    text deletes characters and turns white space into plain spaces.
    """
    if newline_as_space:
        characters = characters.replace("\t", "").replace("\n", "")
    spaces = "".join(c for c in WHITE_SPACE if c not in characters)
    return _split_on_spaces(F.translate(lower_case(text), spaces + characters, " " * len(spaces)))


def join_words(words: str | Column) -> Column:
    return F.array_join(words, " ")
