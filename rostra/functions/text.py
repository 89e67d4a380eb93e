"""Text parsing as column expressions. Every function maps columns to a column; none needs Python."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from rostra import constants as K
from rostra.functions.binding import let

# White space as Unicode text processing sees it; Java's plain \s covers ASCII only.
WS = "\t-\r\\x1c- \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
WS_CHARS = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                             0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
WORD = r"\p{L}\p{N}_"
UNICODE = "(?U)"


def strip(text: Column) -> Column:
    """Trim Unicode white space on both ends."""
    return F.trim(text, F.lit(WS_CHARS))


def clean(text: Column) -> Column:
    """Lower-case, drop links and mail addresses, keep ``a-z0-9+#./-``, collapse spaces."""
    out = F.lower(text)
    # A pattern is walked only where a text has what it needs; "contains" compares bytes.
    out = F.when(out.contains("http") | out.contains("www."), F.regexp_replace(out, rf"https?://[^{WS}]+|www\.[^{WS}]+", " ")).otherwise(out)
    # A mail address is a whole word with an inner "@", so a match is tried at the start of a word only and never goes back.
    out = F.when(out.contains("@"), F.regexp_replace(out, rf"(?<![^{WS}])[^{WS}][^{WS}@]*+@[^{WS}]+", " ")).otherwise(out)
    # Both "not allowed" characters and white space end up as single spaces. Taking what is allowed is faster than
    # replacing what is not.
    return F.array_join(F.regexp_extract_all(out, F.lit(r"[a-z0-9+#./-]+"), 0), " ")


def mask_pii(text: Column) -> Column:
    """Replace mail addresses, then phone-like digit runs, then links."""
    # A pattern is walked only where a text has what it needs. The part before "@" takes a whole run of its characters, so a match is
    # tried at the start of a run, or right behind the match before, and never goes back.
    mail = rf"(?:(?<![{WORD}.+-])|\G)[{WORD}.+-]++@[{WORD}-]+\.[{WORD}.]+"
    out = F.when(text.contains("@"), F.regexp_replace(text, mail, "[EMAIL]")).otherwise(text)
    out = F.regexp_replace(out, rf"(\+?\p{{Nd}}[\p{{Nd}}{WS}().-]{{8,}}\p{{Nd}})", "[PHONE]")
    return let(out, lambda out: F.when(out.contains("http") | out.contains("www."), F.regexp_replace(out, rf"https?://[^{WS}]+|www\.[^{WS}]+", "[URL]")).otherwise(out))


def education_level(text: Column) -> Column:
    """Highest education level named in the text, -1 when none is."""
    low = F.lower(text)
    level = F.lit(-1)
    for value, pattern in reversed(K.EDUCATION_PATTERNS):
        level = F.when(low.rlike(UNICODE + pattern), F.lit(value)).otherwise(level)
    return level


def education_name(level: Column) -> Column:
    name = F.lit(K.EDUCATION_UNKNOWN)
    for value, label in K.EDUCATION_NAMES.items():
        name = F.when(level == value, F.lit(label)).otherwise(name)
    return name


def experience_years(text: Column) -> Column:
    """Largest stated number of years up to 45, else the most senior title word, else 0."""
    low = F.lower(text)
    stated = F.transform(F.regexp_extract_all(low, F.lit(UNICODE + K.YEARS_PATTERN), 1),
                         lambda n: n.try_cast("double"))
    by_title = F.lit(0.0)
    for pattern, years in K.SENIORITY_PATTERNS:
        by_title = F.when(low.rlike(UNICODE + pattern), F.lit(years)).otherwise(by_title)
    return F.coalesce(F.array_max(F.filter(stated, lambda n: n <= K.MAX_YEARS)), by_title)


def certification_count(text: Column) -> Column:
    """Length of the lists after "certifications such as", else the number of certificate words."""
    low = F.lower(text)
    lists = F.regexp_extract_all(low, F.lit(K.CERTIFICATION_LIST_PATTERN), 1)
    listed = F.aggregate(F.transform(lists, lambda e: F.size(F.split(e, ",| and "))), F.lit(0),
                         lambda acc, n: acc + n)
    words = F.regexp_count(low, F.lit(UNICODE + K.CERTIFICATION_WORD_PATTERN))
    return F.when(F.size(lists) > 0, listed).otherwise(words)


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[^{WS}]+"))


def sections_found(text: Column) -> Column:
    low = F.lower(text)
    return F.array_compact(F.array(*[
        F.when(low.rlike(rf"{UNICODE}\b{header}\b"), F.lit(header)) for header in K.SECTION_HEADERS]))


def has_contact_info(text: Column) -> Column:
    return text.rlike(UNICODE + K.CONTACT_PATTERN)


def quality_flags(words: Column, skills: Column, education: Column) -> Column:
    return F.array_compact(F.array(
        F.when(words < K.SHORT_RESUME_WORDS, F.lit(K.FLAG_SHORT)),
        F.when(F.size(skills) == 0, F.lit(K.FLAG_NO_SKILLS)),
        F.when(education < 0, F.lit(K.FLAG_NO_EDUCATION))))


def role_words(role: Column) -> Column:
    """Words of the cleaned job role that are longer than two characters."""
    return F.filter(F.split(clean(F.coalesce(role, F.lit(""))), " "), lambda w: F.length(w) > 2)


def role_hit(words: Column, cleaned_resume: Column) -> Column:
    """Share of the role words that occur anywhere inside the cleaned resume."""
    hits = let(cleaned_resume, lambda text: F.aggregate(words, F.lit(0), lambda n, w: n + text.contains(w).cast("int")))
    return F.coalesce(F.try_divide(hits.cast("double"), F.size(words).cast("double")), F.lit(0.0))


def cut(text: Column, limit: int = K.RESUME_PROMPT_CHARS) -> Column:
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit(" ..."))).otherwise(text)


def sentences(text: Column) -> Column:
    """Sentences of at least five words, without leading or trailing list marks, in text order."""
    parts = F.split(text, rf"(?<=[.!?])[{WS}]+|\n+")
    parts = F.transform(parts, lambda s: F.trim(s, F.lit(" -*")))
    return F.filter(parts, lambda s: word_count(s) >= 5)


def word_tokens(text: Column, stop_words: list[str]) -> Column:
    """Lower-cased word tokens of two or more characters, stop words removed."""
    tokens = F.regexp_extract_all(F.lower(text), F.lit(f"[{WORD}]{{2,}}"), 0)
    if not stop_words:
        return tokens
    return F.filter(tokens, lambda t: ~t.isin(stop_words))


def with_bigrams(tokens: Column) -> Column:
    """The tokens followed by every pair of neighbours."""
    pairs = F.transform(F.slice(tokens, 1, F.greatest(F.size(tokens) - 1, F.lit(0))),
                        lambda t, i: F.concat_ws(" ", t, F.get(tokens, i + 1)))
    return F.concat(tokens, pairs)
