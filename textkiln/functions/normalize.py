"""Normalization of Unicode, white space, markup and Bengali spelling, as column expressions."""

from __future__ import annotations

import html
import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from textkiln.functions import ranges as R
from textkiln.functions.text import strip, sub
from textkiln.functions.workers import by_workers

#: Patterns of the lines that are boilerplate; pass another list to clean_boilerplate().
BOILERPLATE = (
    r"সর্বস্বত্ব\s+সংরক্ষিত",
    r"মন্তব্য\s+করুন",
    r"শেয়ার\s+করুন",
    r"আরও\s+পড়ুন",
    r"বিজ্ঞাপন",
    r"কুকি\s*পলিসি|গোপনীয়তা\s*নীতি",
    r"নিউজলেটার",
    r"সাবস্ক্রাইব",
)
URL, EMAIL = r"https?://\S+|www\.\S+", r"\S+@\S+\.\S+"
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def _by_workers(fn, text: Column, needs: str) -> Column:
    """fn by Arrow workers, only where the pattern matches; texts that it leaves as they are don't travel back."""

    def changed(rows: list) -> list:
        out = (None if x is None else fn(x) for x in rows)
        return [None if new == old else new for old, new in zip(rows, out, strict=True)]

    return F.coalesce(by_workers(lambda: changed, "string", pa.string())(F.when(text.rlike(needs), text)), text)


def nfc(text: Column) -> Column:
    return _by_workers(lambda x: unicodedata.normalize("NFC", x), text, r"[^\x00-\x7F]")


def nfkc(text: Column) -> Column:
    return _by_workers(lambda x: unicodedata.normalize("NFKC", x), text, r"[^\x00-\x7F]")


def xxh64_nfc(text: Column, seed: int = 0) -> Column:
    """XXH64 of the composed text's UTF-8 bytes, as a signed number; F.xxhash64 is the same with the seed 42 and needs no Python."""

    def key(x: str) -> int:
        import xxhash

        return int.from_bytes(xxhash.xxh64_digest(unicodedata.normalize("NFC", x).encode(), seed=seed), "big", signed=True)

    return by_workers(lambda: lambda rows: [None if x is None else key(x) for x in rows], "long", pa.int64())(text)


def unescape(text: Column) -> Column:
    """All HTML entities."""
    return _by_workers(html.unescape, text, "&")


def unescape_common(text: Column) -> Column:
    """The common entities, without Python."""
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def clean_whitespace(text: Column) -> Column:
    """Odd spaces to spaces, runs of spaces to one, line ends to LF, at most one blank line, all lines stripped."""
    text = sub(sub(sub(sub(text, R.one_of(R.ODD_SPACES), " "), " {2,}", " "), r"\r\n?", "\n"), r"\n{3,}", "\n\n")
    return strip(F.array_join(F.transform(F.split(text, "\n"), strip), "\n"))


def cleanup_lite(text: Column) -> Column:
    return clean_whitespace(sub(sub(text, URL), EMAIL))


def remove_symbols(text: Column) -> Column:
    return sub(text, R.one_of(R.USELESS))


def pipe_to_danda(text: Column) -> Column:
    """A pipe becomes a danda unless digits stand on both sides."""
    return sub(text, r"(?<!\d)\||\|(?!\d)", "।")


def squeeze_hasanta(text: Column) -> Column:
    return sub(text, r"\x{09CD}{2,}", "্")


def drop_orphan_marks(text: Column) -> Column:
    return sub(text, r"(^|\s)[\x{09BE}-\x{09CD}\x{09D7}\x{09BC}]+", "$1")


def clean_joiners(text: Column, keep_valid: bool = False) -> Column:
    """Removes ZWJ, ZWNJ and U+E000; keep_valid leaves those between hasanta and consonant, and ZWJ between consonant and hasanta."""
    if keep_valid:
        hasanta, consonant = r"\x{09CD}", r"[\x{0995}-\x{09B9}\x{09DC}-\x{09DF}]"
        # both tests look around the joiner itself: its neighbours are never consumed, so chains of joiners are judged one by one
        return sub(text, rf"(?!(?<={hasanta})[\x{{200C}}\x{{200D}}]{consonant})(?!(?<={consonant})\x{{200D}}{hasanta})[\x{{200C}}\x{{200D}}]|\x{{E000}}")
    return sub(text, r"[\x{200C}\x{200D}\x{E000}]")


def squeeze_punctuation(text: Column) -> Column:
    """Three and more of । ! ? . in any mix become the last of them."""
    return sub(text, r"[।!?.]{2,}([।!?.])", "$1")


def bengali_subset(text: Column) -> Column:
    """The spelling rules that need no dictionary: nukta letters composed, e + aa to o, Assamese letters to Bengali ones.

    They name Bengali letters only, so they work on Bengali spans and leave the rest; runs of spaces and tabs inside a line become one space.
    """
    for a, b in (("ড়", "ড়"), ("ঢ়", "ঢ়"), ("য়", "য়"), ("ো", "ো")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return sub(F.translate(text, "ৰৱ", "রব"), r"[ \t]+", " ")


def cleanup(text: Column) -> Column:
    """The whole cleanup of profile A after Unicode normalization."""
    text = pipe_to_danda(remove_symbols(sub(sub(text, URL), EMAIL)))
    return clean_whitespace(squeeze_punctuation(clean_joiners(drop_orphan_marks(squeeze_hasanta(text)))))


def normalize_document(text: Column, banglish: Column) -> Column:
    """Profile A: entities, NFKC, white space, then by register."""
    text = clean_whitespace(nfkc(unescape(text)))
    return F.when(banglish, cleanup_lite(F.lower(text))).otherwise(cleanup(bengali_subset(text)))


def clean_boilerplate(text: Column, patterns=BOILERPLATE) -> Column:
    """Drops boilerplate lines, then blank runs."""
    found = "|".join(f"(?:{p})" for p in patterns)
    kept = F.array_join(F.filter(F.split(text, "\n"), lambda x: ~x.rlike(found)), "\n")
    return strip(sub(kept, r"\n{3,}", "\n\n"))


def collapse(text: Column) -> Column:
    """All white space runs to one space, stripped."""
    return F.trim(sub(text, r"\s+", " "))


def strip_wikitext(text: Column) -> Column:
    return strip(sub(sub(text, r"\{\{[^{}]*\}\}|\[\[|\]\]|'''?|<[^>]+>"), r"\n{3,}", "\n\n"))


def merge_key(text: Column) -> Column:
    """The text that a merge compares: NFKC, stripped."""
    return strip(nfkc(text))


def paragraphs_of(body: Column) -> Column:
    """Texts of the paragraphs of a piece of HTML; what stands before the first one is left out."""
    parts = F.transform(F.split(body, r"(?i)<p\b[^>]*>"), lambda p: F.trim(sub(unescape_common(sub(p, r"<[^>]*>", " ")), r"\s+", " ")))
    return F.filter(F.slice(parts, F.lit(2), F.greatest(F.size(parts), F.lit(1))), lambda p: p != "")


def article_of_html(page: Column, marker: str | None = None) -> Column:
    """Paragraphs of the article joined by blank lines: scripts, styles and comments go first, then tags.

    The article is the element whose class or id is ``marker`` (a site's own selector), else the <article>, else of the parts that begin with a
    <div> the first one with the most paragraphs if these are three or more, else the page.
    """
    body = sub(page, r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->")
    found = lambda pattern: F.nullif(F.regexp_extract(body, pattern, 2), F.lit(""))
    article = found(r"(?is)(<article[^>]*>)(.*?)</article>")
    divs = F.transform(F.split(body, r"(?i)<div\b[^>]*>"), lambda x, i: F.struct(F.size(paragraphs_of(x)).alias("n"), (-i).alias("first"), x.alias("x")))
    best = F.array_max(F.slice(divs, F.lit(2), F.greatest(F.size(divs), F.lit(1))))
    dense = F.when(best["n"] >= 3, best["x"])
    own = [found(rf"""(?is)(<[a-z]+\b[^>]*\b(?:class|id)\s*=\s*["'][^"']*\b{marker}\b[^>]*>)(.*?)</(?:div|section|main|article)>""")] if marker else []
    return F.array_join(paragraphs_of(F.coalesce(*own, article, dense, body)), "\n\n")


def readable_of_html(page: Column) -> Column:
    """Main text without selectors: of the blocks between structural tags those of 25 words and more whose words are mostly outside links."""
    body = sub(page, r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<(nav|header|footer|aside|form)\b.*?</\1>")
    count = lambda x: F.size(F.filter(F.split(x, r"\s+"), lambda w: w != ""))
    bare = lambda x: F.trim(sub(unescape_common(sub(x, r"<[^>]*>", " ")), r"\s+", " "))
    linked = lambda x: count(bare(F.array_join(F.regexp_extract_all(x, F.lit(r"(?is)<a\b[^>]*>(.*?)</a>"), 1), " ")))
    blocks = F.filter(F.split(body, r"(?i)</?(?:div|section|article|main|td|ul|ol|table|p|h[1-6])\b[^>]*>"), lambda x: (count(bare(x)) >= 25) & (linked(x) * 3 < count(bare(x))))
    return F.array_join(F.transform(blocks, bare), "\n\n")


def title_of_html(page: Column) -> Column:
    return F.trim(unescape_common(F.regexp_extract(page, r"(?is)<title>(.*?)</title>", 1)))


def links_of_html(page: Column) -> Column:
    """Distinct link targets without query and fragment."""
    return F.array_distinct(F.transform(F.regexp_extract_all(page, F.lit(r'href="([^"]*)"'), 1), lambda u: F.regexp_extract(u, r"^([^?#]*)", 1)))


def resolve_links(page: Column, url: Column) -> Column:
    """Distinct links of a page to its own host, absolute, without query and fragment."""
    scheme, host = F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.-]*)://", 1), F.lower(F.regexp_extract(url, r"://([^/?#]*)", 1))
    root = F.concat(scheme, F.lit("://"), host)
    folder = F.regexp_extract(F.regexp_extract(url, r"^([^?#]*)", 1), r"^[^/]*//[^/]*(/.*/|/)", 1)
    base = F.concat(root, F.when(folder == "", "/").otherwise(folder))

    def whole(u: Column) -> Column:
        bare = F.regexp_extract(u, r"^([^?#]*)", 1)
        return F.when(bare.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), bare).when(bare.startswith("//"), F.concat(scheme, F.lit(":"), bare)).when(bare.startswith("/"), F.concat(root, bare)).when(bare != "", F.concat(base, bare))

    found = F.transform(F.regexp_extract_all(page, F.lit(r'href="([^"]*)"'), 1), whole)
    return F.array_distinct(F.filter(found, lambda u: u.isNotNull() & u.rlike("^https?://") & (F.lower(F.regexp_extract(u, r"://([^/?#]*)", 1)) == host)))


def truncate_at_sentence(text: Column, most: int = 2000) -> Column:
    """At most ``most`` characters, cut after the last । or . or newline (in this order) that lies beyond the half."""
    head = F.substring(text, 1, most)
    out = F.when(F.length(text) <= most, text)
    for mark in ("।", ".", "\n"):
        at = F.when(F.contains(head, F.lit(mark)), F.length(head) - F.instr(F.reverse(head), mark) + 1).otherwise(0)
        out = out.when(at - 1 > most // 2, F.substring(head, F.lit(1), at))
    return out.otherwise(head)
