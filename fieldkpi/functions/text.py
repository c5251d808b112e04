"""Text cleaning rules as native Column expressions (no Python in the hot path).

Both cleaners reduce to a per-character fold followed by a few regular
expressions. The folds are *generated by rule* from the Unicode database at
import time and applied with ``translate`` (single-character images) plus one
``regexp_replace`` per multi-character image, so Spark evaluates them in the JVM.
"""

from __future__ import annotations

import functools
import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.isspace() set for ASCII plus the Unicode spaces; used where the
# source trims with str.strip() (Java's \s is ASCII-only and lacks \x1c-\x1f).
PY_SPACE_CLASS = r"[\t\n\x0b\x0c\r\x1c-\x1f \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def _strip_marks(s: str, form: str) -> str:
    return "".join(ch for ch in unicodedata.normalize(form, s) if unicodedata.category(ch) != "Mn")


@functools.lru_cache(maxsize=1)
def name_fold() -> tuple[str, str, dict[str, str]]:
    """Per-character image of the name cleaner, over all of Unicode.

    Rule: upper-case, canonical decomposition, drop non-spacing marks, turn
    ``- . ,`` into a space, keep only ``A-Z`` and space. Returns the translate
    arguments for single-character images and a map image -> characters for the
    multi-character ones (for example the sharp s gives ``SS``).
    """
    src, dst = [], []
    multi: dict[str, list[str]] = {}
    for cp in range(0x110000):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        if cp >= 0x250 and ch.upper() == ch and not unicodedata.decomposition(ch):
            continue  # its own image, so dropped
        img = _strip_marks(ch.upper(), "NFD")
        img = re.sub(r"[-.,]", " ", img)
        img = re.sub(r"[^A-Z ]", "", img)
        if not img or img == ch:
            continue
        if len(img) == 1:
            src.append(ch)
            dst.append(img)
        else:
            multi.setdefault(img, []).append(ch)
    return "".join(src), "".join(dst), {k: "".join(v) for k, v in multi.items()}


# FIXED VALUES: transliterations of the closing-text cleaner for lower-case
# letters and signs that have no decomposition into ASCII.
CLOSING_SPECIAL = {
    "ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "đ": "d", "ð": "d", "þ": "th", "ł": "l",
    "ı": "i", "ŀ": "l", "ĸ": "k", "ſ": "s", "ŋ": "ng", "ħ": "h", "ŧ": "t",
    "º": "o", "ª": "a", "–": "-", "—": "-", "―": "-", "‐": "-", "‑": "-", "‒": "-", "−": "-",
    "‘": "'", "’": "'", "‚": "'", "‛": "'", "“": '"', "”": '"', "„": '"', "‟": '"',
    "«": "<<", "»": ">>", "…": "...", "•": "*", "·": "*", "¿": "?", "¡": "!",
    "°": "deg", "×": "x", "÷": "/", "€": "EUR", "£": "PS", "¢": "C/", "¥": "Y=",
}


# FIXED VALUES: transliterations of lower-case Greek and Cyrillic letters
GREEK = {
    "α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "θ": "th", "ι": "i", "κ": "k", "λ": "l",
    "μ": "m", "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "ς": "s", "σ": "s", "τ": "t", "υ": "u", "φ": "ph",
    "χ": "kh", "ψ": "ps", "ω": "o",
}
CYRILLIC = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ж": "zh", "з": "z", "и": "i", "й": "i", "к": "k",
    "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "kh",
    "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ъ": "\"", "ы": "y", "ь": "'", "э": "e", "ю": "iu", "я": "ia",
    "ё": "io", "ђ": "dj", "є": "ie", "ѕ": "dz", "і": "i", "ї": "yi", "ј": "j", "љ": "lj", "њ": "nj", "ћ": "ch",
    "ў": "u", "џ": "dzh", "ґ": "g",
}
# FIXED VALUES: transliterations of Hebrew letters, and of Arabic and Persian ones (vowel
# points are marks and vanish; signs become spaces later)
HEBREW = {
    "א": "a", "ב": "b", "ג": "g", "ד": "d", "ה": "h", "ו": "v", "ז": "z", "ח": "kh", "ט": "t", "י": "y", "ך": "k", "כ": "k",
    "ל": "l", "ם": "m", "מ": "m", "ן": "n", "נ": "n", "ס": "s", "ע": "`", "ף": "p", "פ": "p", "ץ": "ts", "צ": "ts", "ק": "q",
    "ר": "r", "ש": "sh", "ת": "t",
}
ARABIC = {
    "ء": "", "ا": "", "ب": "b", "ة": "@", "ت": "t", "ث": "th", "ج": "j", "ح": "h", "خ": "kh", "د": "d", "ذ": "dh", "ر": "r",
    "ز": "z", "س": "s", "ش": "sh", "ص": "s", "ض": "d", "ط": "t", "ظ": "z", "ع": "`", "غ": "g", "ـ": "", "ف": "f", "ق": "q",
    "ك": "k", "ل": "l", "م": "m", "ن": "n", "ه": "h", "و": "w", "ى": "~", "ي": "y", "پ": "p", "چ": "ch", "ژ": "zh", "ک": "k",
    "گ": "g", "ی": "y",
}
_LETTERS = GREEK | CYRILLIC | HEBREW | ARABIC
# FIXED VALUES: kana whose usual romanisation isn't the one in their character names
KANA = {"si": "shi", "ti": "chi", "tu": "tsu"}


@functools.lru_cache(maxsize=1)
def _kana() -> dict[str, str]:
    """Romanised kana, from the names of the characters (HIRAGANA LETTER SMALL YA: ya)."""
    out = {"ー": ""}
    for cp in range(0x3041, 0x30FB):
        found = re.fullmatch(r"(HIRAGANA|KATAKANA) LETTER (SMALL )?([A-Z]+)", unicodedata.name(chr(cp), ""))
        if found:
            sound = found[3].lower()
            out[chr(cp)] = KANA.get(sound, sound)
    return out


@functools.lru_cache(maxsize=1)
def _jamo() -> tuple[list[str], list[str], list[str]]:
    """Romanised initials, vowels and finals of Hangul, from the names of the
    syllables (HANGUL SYLLABLE GAG), which number them as (initial, vowel, final)."""
    def sound(initial: int, vowel: int, final: int) -> str:
        return unicodedata.name(chr(0xAC00 + (initial * 21 + vowel) * 28 + final)).rpartition(" ")[2].lower()

    initials = [sound(i, 0, 0)[:-1] for i in range(19)]
    vowels = [sound(11, v, 0) for v in range(21)]  # the initial numbered 11 is silent
    return initials, vowels, [sound(11, 0, f)[1:] for f in range(28)]


def _romanise_hangul(col: Column) -> Column:
    """Hangul syllables by arithmetic on their numbers; other characters stay."""
    initials, vowels, finals = (F.array(*[F.lit(x) for x in part]) for part in _jamo())

    def one(c):
        n = F.ascii(c) - F.lit(0xAC00)
        sound = F.concat(F.get(initials, F.floor(n / 588).cast("int")), F.get(vowels, F.floor(n % 588 / 28).cast("int")), F.get(finals, n % 28))
        return F.when((n >= 0) & (n < 19 * 588), sound).otherwise(c)

    return F.when(col.rlike("[\\x{AC00}-\\x{D7A3}]"), F.array_join(F.transform(F.split(col, ""), one), "")).otherwise(col)


@functools.lru_cache(maxsize=1)
def closing_fold() -> tuple[str, str, dict[str, str]]:
    """Per-character ASCII transliteration of lower-cased text, all of Unicode.

    Rule: CLOSING_SPECIAL and the letter tables first, kana and single Hangul
    letters by their names, decimal digits of all scripts; whitespace -> space;
    marks and format characters vanish; otherwise the compatibility
    decomposition without marks, each of its characters by the same rule.
    Characters without an image are left for the sign rule.
    """
    keep: list[tuple[str, str]] = []
    drop: list[str] = []
    multi: dict[str, list[str]] = {}
    kana = _kana()
    initials, vowels, finals = _jamo()
    jamo = {chr(start + i): x for start, part in ((0x1100, initials), (0x1161, vowels), (0x11A8, finals[1:])) for i, x in enumerate(part)}

    def image(ch: str) -> str | None:
        if ch.isascii():
            return ch
        if ch in CLOSING_SPECIAL:
            return CLOSING_SPECIAL[ch]
        if ch in _LETTERS:
            return _LETTERS[ch]
        if ch in kana:
            return kana[ch]
        if ch in jamo:
            return jamo[ch]
        if ch == "\u2044":  # fraction slash
            return "/"
        if unicodedata.decimal(ch, None) is not None:
            return str(unicodedata.decimal(ch))
        if ch.isspace():
            return " "
        if unicodedata.category(ch) in ("Mn", "Me", "Cf"):
            return ""
        parts = unicodedata.normalize("NFKD", ch)
        if parts == ch:
            return None
        images = [image(c.lower()) for c in parts]
        return None if None in images or not "".join(images) else "".join(images)

    for cp in range(0x80, 0x110000):
        if 0xD800 <= cp <= 0xDFFF or 0xAC00 <= cp <= 0xD7A3:
            continue
        ch = chr(cp)
        img = image(ch)
        if img is None:
            continue
        img = img.lower() if ch not in CLOSING_SPECIAL else img
        if img == "":
            drop.append(ch)
        elif len(img) == 1:
            keep.append((ch, img))
        else:
            multi.setdefault(img, []).append(ch)
    # translate() deletes 'matching' characters beyond the end of 'replace',
    # so the characters that vanish go last.
    src = "".join(c for c, _ in keep) + "".join(drop)
    dst = "".join(i for _, i in keep)
    return src, dst, {k: "".join(v) for k, v in multi.items()}


def _apply_fold(col: Column, fold: tuple[str, str, dict[str, str]]) -> Column:
    """Apply a per-character fold.

    ASCII entries (the name fold's a-z and ``-.,``) go through one small
    ``translate``. Non-ASCII entries run only for texts that hold a non-ASCII
    character (one scan decides): single-character images in one ``translate``;
    multi-character ones of letters in common use as literal replaces (no regex,
    no copy when absent); the many rare ones (squared units, circled and
    enclosed signs ...) by a lookup per character, only for texts that still
    hold one. Images are ASCII and already final, so the parts don't interact.
    """
    src, dst, multi = fold
    n_kept = len(dst)
    pairs = list(zip(src[:n_kept], dst))
    dropped = src[n_kept:]
    a_src = "".join(c for c, _ in pairs if ord(c) < 128)
    a_dst = "".join(d for c, d in pairs if ord(c) < 128)
    n_src = "".join(c for c, _ in pairs if ord(c) >= 128) + dropped
    n_dst = "".join(d for c, d in pairs if ord(c) >= 128)
    if a_src:
        col = F.translate(col, a_src, a_dst)
    base = F.translate(col, n_src, n_dst)
    common, rare = {}, {}
    for img, chars in multi.items():
        for ch in chars:
            (common if ord(ch) < 0x250 or ch in CLOSING_SPECIAL or ch in _LETTERS else rare)[ch] = img
    folded = base
    for ch, img in common.items():
        folded = F.replace(folded, F.lit(ch), F.lit(img))
    if rare:
        # a range that holds them all: a class of single characters is tried one by one
        table = F.create_map(*[F.lit(x) for kv in rare.items() for x in kv])
        one_by_one = F.array_join(F.transform(F.split(folded, ""), lambda c: F.coalesce(F.try_element_at(table, c), c)), "")
        folded = F.when(col.rlike("[\\x{250}-\\x{10FFFF}]"), one_by_one).otherwise(folded)
    return F.when(col.rlike("[^\\x00-\\x7F]"), folded).otherwise(col)


def _name_core(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    s = _apply_fold(c, name_fold())
    s = F.regexp_replace(s, "[^A-Z ]", "")
    return F.trim(F.regexp_replace(s, " +", " "))


def clean_name(col: Column | str) -> Column:
    """Person-name cleaner: null stays null; upper; accents off; ``-.,`` to space;
    only A-Z and space; spaces collapsed and trimmed; empty gives null."""
    return F.nullif(_name_core(col), F.lit(""))


def with_clean_names(df, cols: list[str]):
    """``clean_name`` on several columns, the folded text projected once per
    column (the empty test then reads a column instead of recomputing it)."""
    for c in cols:
        tmp = f"__n_{abs(hash(c))}"
        df = df.withColumn(tmp, _name_core(c)).withColumn(c, F.nullif(F.col(tmp), F.lit(""))).drop(tmp)
    return df


# ASCII characters the closing-text rule turns into a space: all but a-z, 0-9
# and Python's ASCII whitespace (by rule)
_ASCII_SIGNS = "".join(chr(i) for i in range(128)
                       if not (chr(i).isascii() and (chr(i).islower() and chr(i).isalpha() or chr(i).isdigit()
                                                     or chr(i).isspace())))


def clean_closing_text(col: Column | str) -> Column:
    """Closing-text cleaner: null gives ''; lower; trim; transliterate to ASCII;
    ``_`` and ``-`` to space; other signs to space; spaces collapsed; trimmed."""
    c = F.col(col) if isinstance(col, str) else col
    s = F.lower(c)
    s = F.regexp_replace(s, f"^{PY_SPACE_CLASS}+|{PY_SPACE_CLASS}+$", "")
    s = _romanise_hangul(_apply_fold(s, closing_fold()))
    # '_' '-' and every other ASCII sign become a space: one translate (no
    # per-match regex cost); a leftover non-ASCII character (rare after the
    # fold) goes through the regex only when present.
    s = F.translate(s, _ASCII_SIGNS, " " * len(_ASCII_SIGNS))
    s = F.when(s.rlike("[^\\x00-\\x7F]"), F.regexp_replace(s, "[^\\x00-\\x7Fáéíóúüñ]", " ")).otherwise(s)
    s = F.regexp_replace(s, r"[\t\n\x0b\x0c\r\x1c-\x1f ]+", " ")
    s = F.trim(s)
    return F.coalesce(s, F.lit(""))


def blank_markers(col: Column | str, markers: list[str]) -> Column:
    """Whole-cell empty markers become null."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(~c.isin(markers), c)

