"""Text to typed values, with the strictness of the payload contract.

Each function takes and returns SQL text, for use in ``selectExpr`` or ``expr``. ``cast`` may
be ``try_cast``, which gives NULL where the value does not fit.
"""

from __future__ import annotations

# Spellings accepted for booleans besides those Spark takes itself.
TRUE_WORDS = ("tr", "tru", "ye", "on")
FALSE_WORDS = ("fa", "fal", "fals", "of", "off")


def _words(words: tuple[str, ...]) -> str:
    return ", ".join(f"'{word}'" for word in words)


def blank_to_null(text: str) -> str:
    return f"nullif({text}, '')"


def to_double(text: str, cast: str = "cast") -> str:
    return f"{cast}({blank_to_null(text)} as double)"


def to_int(text: str, cast: str = "cast") -> str:
    return f"{cast}({blank_to_null(text)} as int)"


def to_boolean(text: str, cast: str = "cast") -> str:
    """True/false words in any case; anything else fails under ANSI mode."""
    word = f"lower(trim({text}))"
    return (
        f"case when {word} in ({_words(TRUE_WORDS)}) then true "
        f"when {word} in ({_words(FALSE_WORDS)}) then false "
        f"else {cast}({blank_to_null(text)} as boolean) end"
    )


def to_doubles(texts: str) -> str:
    """An array of texts; what is not a number becomes NULL."""
    return f"transform({texts}, value -> try_cast(value as double))"
