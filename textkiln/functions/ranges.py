"""Code-point classes, as ranges and as regular-expression classes that Java and RE2 read alike."""

from __future__ import annotations

#: Unicode blocks and characters.
BENGALI = ((0x0980, 0x09FF),)
BENGALI_LETTERS = ((0x0980, 0x09E3), (0x09FC, 0x09FC), (0x09FE, 0x09FE))  # letters and signs, without digits and U+09F0/1
ASSAMESE = ((0x09F0, 0x09F1),)
DANDA = ((0x0964, 0x0965),)
LATIN = ((0x41, 0x5A), (0x61, 0x7A), (0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x24F))
DEVANAGARI = ((0x0900, 0x0963), (0x0966, 0x097F))  # without the dandas
#: Scripts of other languages of South Asia and Arabic.
BLOCKED = (
    (0x0900, 0x0963), (0x0966, 0x097F), (0xA8E0, 0xA8FF), (0x1CD0, 0x1CFF), (0x0A00, 0x0A7F), (0x0A80, 0x0AFF), (0x0B00, 0x0B7F),
    (0x0B80, 0x0BFF), (0x0C00, 0x0C7F), (0x0C80, 0x0CFF), (0x0D00, 0x0D7F), (0x0D80, 0x0DFF), (0x0600, 0x06FF), (0x0750, 0x077F),
    (0x0870, 0x089F), (0x08A0, 0x08FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF), (0xA800, 0xA82F), (0xAAE0, 0xAAFF), (0xABC0, 0xABFF),
)
EMOJI = ((0x1F300, 0x1FAFF), (0x1F1E6, 0x1F1FF), (0x2600, 0x26FF), (0x2700, 0x27BF), (0x1F000, 0x1F0FF), (0x2B00, 0x2BFF))
USELESS = ((0x2500, 0x25FF), (0x27C0, 0xFDFF), (0xFE10, 0x1EFFF))
ODD_SPACES = ((0xA0, 0xA0), (0x2000, 0x200B), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000), (0xFEFF, 0xFEFF))


def inner(*groups: tuple) -> str:
    """The inside of a character class for groups of ranges."""
    return "".join(f"\\x{{{lo:04X}}}" if lo == hi else f"\\x{{{lo:04X}}}-\\x{{{hi:04X}}}" for group in groups for lo, hi in group)


def one_of(*groups: tuple) -> str:
    return f"[{inner(*groups)}]"


def none_of(*groups: tuple) -> str:
    return f"[^{inner(*groups)}]"
