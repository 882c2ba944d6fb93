"""Text operators as Column functions: everything here stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import IMAGE_OPTIONS, IMAGE_PARAMETERS, METADATA_CLASSES, MONTH_DAYS, PROTOCOLS, SiteConfig

URL = r"(?U)[a-z]++:(?:[\w!#$&'()*+,\-./:;=?@_~]++|%[0-9a-fA-F]{2})++"


def let(value: Column, body) -> Column:
    """body(value) with the value computed once: a nested expression would repeat it in the plan and in generated code."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ucfirst(s: Column) -> Column:
    return F.concat(F.upper(F.substring(s, 1, 1)), F.substring(s, F.lit(2), F.length(s)))


def xml_escape(s: Column) -> Column:
    for a, b in (("&", "&amp;"), ('"', "&quot;"), ("'", "&apos;"), ("<", "&lt;"), (">", "&gt;")):
        s = F.replace(s, F.lit(a), F.lit(b))
    return s


def percent_encode(s: Column) -> Column:
    """Each character but A-Z, a-z, 0-9 becomes % and its code point in upper-case hex, two digits at least."""
    code = lambda c: F.conv(F.hex(F.encode(c, "UTF-32BE")), 16, 16)
    one = lambda c: F.when(c.rlike("^[A-Za-z0-9]$"), c).otherwise(F.concat(F.lit("%"), F.lpad(code(c), 2, "0")))
    return F.array_join(F.transform(F.filter(F.regexp_extract_all(s, F.lit("(?s)(.)")), lambda c: c != ""), one), "")


def pad_to(s: Column, length: Column, pad: Column | None = None, left: bool = True) -> Column:
    """Pads to the total width that ``length`` starts with (500 at most); the pad is 0 if missing, empty or 0; never cuts."""
    n = F.least(F.coalesce(F.nullif(F.regexp_extract(length, r"^\s*([0-9]{1,9})", 1), F.lit("")).cast("int"), F.lit(0)), F.lit(500))
    pad = F.lit("0") if pad is None else F.coalesce(F.nullif(pad, F.lit("")), F.lit("0"))
    return F.call_function("lpad" if left else "rpad", s, F.greatest(F.length(s), n), pad)


def strip_comments(s: Column) -> Column:
    return F.regexp_replace(s, r"(?s)<!--.*?-->", "")


def strip_blocks(s: Column) -> Column:
    return F.regexp_replace(s, r"(?s)<(includeonly|onlyinclude|timeline)>.*?</\1>", " ")


def break_lines(s: Column) -> Column:
    return F.regexp_replace(s, r"<br ?/?>", "\n\n")


def strip_math(s: Column) -> Column:
    return F.regexp_replace(s, r"(?is)<math[^>]*>.*?</math>", " ")


def strip_tables(s: Column, passes: int = 5) -> Column:
    s = F.regexp_replace(s, r"(?is)<table\b[^>]*>.*?</table>", "\n")
    for _ in range(passes):
        s = F.regexp_replace(s, r"(?s)\{\|(?:(?!\{\|).)*?\|\}(?!\})", "\n")
    return s


def strip_metadata(s: Column) -> Column:
    return F.regexp_replace(s, rf"(?is)<(div|span)\s[^>]*?class=\"[^\">]*?(?:{METADATA_CLASSES})[^\">]*\"[^>]*>[^<]*</\1>", " ")


def strip_emphasis(s: Column) -> Column:
    for n in (5, 3, 2):
        q = "'" * n
        s = F.regexp_replace(s, rf"{q}([^\n]*?){q}", "$1")
    return s


def collapse_newlines(s: Column) -> Column:
    return F.regexp_replace(s, r"(?U)[ \t\x0b\f\r]*\n[ \t\x0b\f\r]*\n\s*", "\n\n")


def strip_tags(s: Column, passes: int = 3) -> Column:
    """Tags to blanks, and what becomes a tag by that, ``passes`` times in all (pages go on until none is left)."""
    for _ in range(passes):
        s = F.regexp_replace(s, r"</?[A-Za-z][^<>]*>", " ")
    return s


def strip_entities(s: Column) -> Column:
    return F.regexp_replace(s, r"(?U)&#?\w+;", " ")


def headings(s: Column) -> Column:
    for n, tag in ((5, "h4"), (4, "h3"), (3, "h2"), (2, "h1")):
        q = "=" * n
        s = F.regexp_replace(s, rf"(?mdU)^{q}([^\n]*?){q}(?=[^\S\n]*$)", f"<{tag}>$1</{tag}>")
    return s


def is_stub(s: Column) -> Column:
    return F.lower(s).contains("stub}}")


def is_disambig(text: Column, title: Column, cfg: SiteConfig) -> Column:
    named = text.rlike(rf"(?i)\{{\{{\s*(?:{cfg.disambig_templates})\s*(?:\|[^\n]*)?\}}\}}")
    return F.coalesce(named, F.lit(False)) | F.coalesce(title.rlike(f"(?i){cfg.disambig_title}"), F.lit(False))


def normalize_ns(s: Column, cfg: SiteConfig) -> Column:
    name = ucfirst(F.lower(s))
    for a, b in cfg.aliases:
        name = F.when(name == a, F.lit(b)).otherwise(name)
    return name


def split_title(s: Column, known: list[str], cfg: SiteConfig, default_ns: str | None = None) -> Column:
    """struct(ns, title) of a raw title; ``known`` are the namespace names of the dump and the interwiki prefixes."""
    s = F.regexp_replace(s, r"^[ \f\n\r\t_]+|[ \f\n\r\t_]+$", "")
    s = F.regexp_replace(F.regexp_replace(s, r"[ \f\n\r\t_]+", " "), "[\u200e\u200f]", "")
    if not default_ns:
        s = F.regexp_replace(s, r"^: *", "")
    pattern = r"(?s)^([^:]*):\s*(\S.*)$"
    pair = lambda ns, title: F.struct(ns.alias("ns"), ucfirst(title).alias("title"))

    def cut(s: Column) -> Column:
        prefix = let(F.regexp_extract(s, pattern, 1), lambda p: normalize_ns(p, cfg))
        return let(prefix, lambda p: F.when(p.isin("", *known) & s.rlike(pattern), pair(p, F.regexp_extract(s, pattern, 2))).otherwise(pair(F.lit(default_ns or ""), s)))

    return let(s, cut)


def full_title(split: Column) -> Column:
    return F.when(~split["ns"].isin("", "0"), F.concat(split["ns"], F.lit(":"), split["title"])).otherwise(split["title"])


def normalize_title(s: Column, known: list[str], cfg: SiteConfig, default_ns: str | None = None) -> Column:
    return let(split_title(s, known, cfg, default_ns), full_title)


def redirect_target(text: Column, cfg: SiteConfig) -> Column:
    """The raw link of a redirect page without its section; null if the text is no redirect."""
    quick, parse = (f"(?i){p}" for p in cfg.redirect)
    link = F.regexp_extract(text, parse, 1)
    return F.when(text.rlike(quick) & text.rlike(parse), F.regexp_replace(link, r"(?s)#[^#]*$", ""))


def template_body(text: Column) -> Column:
    """What a template contributes where it is included."""
    text = strip_comments(text)
    only = F.regexp_extract_all(text, F.lit(r"(?s)<onlyinclude>(.*?)</onlyinclude>"), F.lit(1))
    rest = F.regexp_replace(F.regexp_replace(text, r"(?s)<noinclude>.*?</noinclude>", ""), r"(?s)<noinclude>.*$", "")
    rest = F.regexp_replace(rest, r"(?s)<includeonly>(.*?)</includeonly>", "$1")
    return F.when(F.size(only) > 0, F.array_join(F.transform(only, lambda x: F.concat(x, F.lit("\n"))), "")).otherwise(rest)


def normalize_date(link: Column, cfg: SiteConfig) -> Column:
    """Wikitext that a date link is rewritten to, or null."""
    months = F.array(*[F.lit(m) for m in cfg.months])
    days = F.array(*[F.lit(d) for d in MONTH_DAYS])
    first = F.trim(link)
    word = r"^([0-9]{1,2})\s+([A-Za-z]+)$"
    named = F.initcap(F.regexp_extract(first, word, 2))
    day = F.regexp_extract(first, word, 1)
    numeric = r"^(?:([0-9]{3,4})-)?([0-9]{1,2})-([0-9]{1,2})$"
    year, mm, dd = (F.regexp_extract(first, numeric, i) for i in (1, 2, 3))
    m = F.nullif(mm, F.lit("")).cast("int")
    fits = first.rlike(numeric) & (m >= 1) & (m <= 12) & (dd.try_cast("int") >= 1) & (dd.try_cast("int") <= F.get(days, m - 1))
    text = F.concat(F.lit("[["), F.get(months, m - 1), F.lit(" "), dd, F.lit("]]"))
    tail = F.when(year != "", F.concat(F.lit(", [["), year, F.lit("]]"))).otherwise("")
    at = F.array_position(months, named).cast("int")
    return F.when(first.rlike(word) & (day.try_cast("int") >= 1) & (day.try_cast("int") <= F.get(days, at - 1)), F.concat(F.lit("[["), named, F.lit(" "), day, F.lit("]]"))).when(fits, F.concat(text, tail))


def dump_name(path: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(path, r"([a-z]+)-[0-9a-z_]+-pages-articles\.xml", 1), F.lit("")), F.lit("unknown"))


def dump_date(path: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(path, r"[a-z]+-([0-9a-z_]+)-pages-articles\.xml", 1), F.lit("")), F.lit("unknown"))


def image_caption(fields: Column) -> Column:
    """The longest field that is no size, placement, type or named parameter; the first of equals; else empty."""
    skip = rf"(?is)^\s*(?:{IMAGE_OPTIONS})\s*$|^\s*(?:{IMAGE_PARAMETERS})="
    left = F.filter(fields, lambda x: ~x.rlike(skip))
    return F.aggregate(left, F.lit(""), lambda best, x: F.when(F.length(x) > F.length(best), x).otherwise(best))


def dedup_drop(ids: Column, own: Column | None = None) -> Column:
    return F.array_distinct(ids if own is None else F.filter(ids, lambda x: x != own))


def array_minus(a: Column, b: Column) -> Column:
    return F.filter(a, lambda x: ~F.array_contains(b, x))


def link_ids(links: Column) -> Column:
    return F.filter(F.transform(links, lambda x: x["target_id"]), lambda x: x.isNotNull())


# Names of wiki language codes that are no language tags, or that locale data lacks.
WIKI_LANGUAGES = {
    "als": "Alemannisch",
    "bat-smg": "Žemaitėška",
    "be-tarask": "Беларуская (тарашкевіца)",
    "be-x-old": "Беларуская (тарашкевіца)",
    "cbk-zam": "Chavacano de Zamboanga",
    "de-formal": "Deutsch (Sie-Form)",
    "fiu-vro": "Võro",
    "ike-cans": "ᐃᓄᒃᑎᑐᑦ",
    "ike-latn": "inuktitut",
    "ksh": "Ripoarisch",
    "map-bms": "Basa Banyumasan",
    "nds": "Plattdüütsch",
    "nds-nl": "Nedersaksisch",
    "pt-br": "Português do Brasil",
    "roa-rup": "Armãneashce",
    "roa-tara": "Tarandíne",
    "ruq-cyrl": "Влахесте",
    "ruq-grek": "Βλαεστε",
    "ruq-latn": "Vlăheşte",
    "simple": "Simple English",
    "sr-ec": "ћирилица",
    "sr-el": "latinica",
    "sr-jc": "ијекавица",
    "sr-jl": "ijekavica",
    "tokipona": "Toki Pona",
    "zh-classical": "古文 / 文言文",
    "zh-min-nan": "Bân-lâm-gú",
    "zh-yue": "粵語",
}


_names: dict[str, str] = {}


def language_names(spark) -> dict[str, str]:
    """Language codes to the languages' own names: the JVM's locale data, and the wikis' own codes beside it."""
    if not _names:
        locale = spark._jvm.java.util.Locale
        codes = set(locale.getISOLanguages()) | {x.getLanguage() for x in locale.getAvailableLocales()}
        for code in sorted(c for c in codes if c):
            own = locale.forLanguageTag(code)
            name = own.getDisplayLanguage(own)
            if name and name != code:
                _names[code] = name[:1].upper() + name[1:]
        _names.update(WIKI_LANGUAGES)
    return dict(_names)


def language_name(code: Column, names: dict[str, str]) -> Column:
    table = F.create_map(*[F.lit(x) for kv in sorted(names.items()) for x in kv])
    return F.coalesce(F.element_at(table, F.lower(code)), code)


def bare_urls(text: Column) -> Column:
    """Distinct URLs of the allowed protocols, in order."""
    every = F.regexp_extract_all(text, F.lit(f"({URL})"), F.lit(1))
    return F.array_distinct(F.filter(every, lambda u: F.substring_index(u, ":", 1).isin(*PROTOCOLS)))
