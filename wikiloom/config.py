"""Site configurations: names, wordings and limits that differ between wikis."""

from __future__ import annotations

from dataclasses import dataclass, replace

# Month names, wordings, namespaces and patterns of the supported sites.
_EN_MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
_SL_MONTHS = ("Januar", "Februar", "Marec", "April", "Maj", "Junij", "Julij", "Avgust", "September", "Oktober", "November", "December")
_RU_MONTHS = ("Январь", "Февраль", "Март", "Апрель", "Май", "Июнь", "Июль", "Август", "Сентябрь", "Октябрь", "Ноябрь", "Декабрь")
_EN_STANDALONE = r"Main\s+articles?|Further\s+information|Related\s+articles?|Related\s+topics?|See\s+main\s+articles?|See\s+articles?|See\s+also|For\s+(?:more|further)"
_EN_INLINE = r"See[\s:]|See\s+also|For\s+(?:more|further)"
_EN_SECTION = r"Further\s+information|See\s+also|Related\s+articles?|Related\s+topics?"
_SL_STANDALONE = r"Glavni\s+član(?:ek|ki)|Dodatne\s+informacije|Povezani\s+član(?:ek|ki)|Povezan(?:a|e)\s+tem(?:a|e)|Glej\s+glavn(?:i|e)\s+član(?:ek|ke)|Glej\s+član(?:ek|ke)|Glej\s+tudi|Za\s+(?:več|dodatn[io]|nadaljn[io])"
_SL_INLINE = r"Glej[\s:]|Glej\s+tudi|Za\s+(?:več|dodatn[io]|nadaljn[io])"
_SL_SECTION = r"Dodatne\s+informacije|Glej\s+tudi|Povezani?\s+član(?:ek|ki)|Povezan[ea]\s+tem[ea]"
_RU_STANDALONE = r"Основная\s+статьяs?|Основные\s+статьиs?|Further\s+information|Related\s+articles?|Related\s+topics?|See\s+main\s+articles?|See\s+articles?|См\.\s+также|См\.\s+также\s+статью|For\s+(?:more|further)"
_RU_INLINE = r"См\.[\s:]|См\.\s+также|For\s+(?:more|further)"
# "givenname" has no blank: the pattern it comes from ignores blanks.
_EN_DISAMBIG = r"disambiguation|disambig|disambig-cleanup|disamb|dab|shipindex|hndis|surname|geodis|schooldis|hospitaldis|mathdab|numberdis|givenname"
_RU_DISAMBIG = r"неоднозначность|disambig|disambig-cleanup|dab|hndis|surname|geodis|schooldis|hospitaldis|mathdab"
_SL_DISAMBIG = r"razločitev|razločitveni|disambig"
_EN_INTERWIKI = ("File", "Wookieepedia", "Memoryalpha", "Wowwiki", "Marveldatabase", "Dcdatabase")
#: Image fields that are options, and parameters that are no caption.
IMAGE_OPTIONS = r"[0-9x]+px(?:px)?|left|right|center|none|thumb(?:nail)?|frame(?:less|d)?|border|baseline|middle|sub|super|text-top|text-bottom|top|bottom"
IMAGE_PARAMETERS = r"alt|link|upright|thumb(?:nail)?"
#: Classes of elements that hold metadata.
METADATA_CLASSES = r"metadata|dablink|sisterproject|longitude|latitude|geo-multi-punct|geo-dec|geo"
PROTOCOLS = ("http", "https", "ftp", "irc", "gopher", "telnet", "nntp", "worldwind", "mailto", "news")
MONTH_DAYS = (31, 29, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)


def _redirect(words: str, lead: str = "") -> tuple[str, str]:
    """Quick predicate and parser of a redirect; the parser's first group is the link."""
    return rf"^{lead}#(?:{words})", rf"^{lead}#(?:{words})(?:S|ED|ION)?\s*(?::|\sTO|=)?\s*\[\[([^\]]*)\]\]"


@dataclass(frozen=True)
class SiteConfig:
    name: str
    category_ns: str
    template_ns: str
    image_ns: str
    months: tuple[str, ...] = _SL_MONTHS
    aliases: tuple[tuple[str, str], ...] = ()
    related_standalone: str = _SL_STANDALONE
    related_inline: str = _SL_INLINE
    related_section: str = _SL_SECTION
    override_templates: tuple[tuple[str, str], ...] = ()
    content_ns: tuple[str, ...] = ()
    interwiki_ns: tuple[str, ...] = ()
    disambig_templates: str = _SL_DISAMBIG
    disambig_title: str = r"\(razdvojba\)"
    redirect: tuple[str, str] = _redirect("REDIRECT")
    int_lang: str = "en"
    template_levels: int = 10
    parameter_passes: int = 10
    table_passes: int = 5
    longest_invocation: int = 32767

    @property
    def prescan_ns(self) -> tuple[str, ...]:
        return (self.category_ns, self.template_ns, self.image_ns, *self.content_ns)

    @property
    def transform_ns(self) -> tuple[str, ...]:
        return (self.category_ns, self.image_ns, *self.content_ns)


def _site(name: str, category: str, template: str, image: str, words: str = "REDIRECT", title: str = r"\(razdvojba\)", interwiki: bool = True) -> SiteConfig:
    return SiteConfig(name, category, template, image, interwiki_ns=(image, "En") if interwiki else (), disambig_title=title, redirect=_redirect(words))


_EN = SiteConfig(
    "enwiki", "Category", "Template", "File", _EN_MONTHS, (("Image", "File"),), _EN_STANDALONE, _EN_INLINE, _EN_SECTION,
    (("Template:Int:Lang", "en"),), (), _EN_INTERWIKI, _EN_DISAMBIG, r"\(disambiguation\)", _redirect("REDIRECT", r"\s*"),
)
SITES: dict[str, SiteConfig] = {
    c.name: c
    for c in (
        _EN,
        _site("slwiki", "Kategorija", "Predloga", "Slika", "REDIRECT|PREUSMERITEV", r"\(razločitev\)", False),
        _site("etwiki", "Kategooria", "Mall", "Pilt", "REDIRECT|SUUNA"),
        _site("ltwiki", "Kategorija", "Šablonas", "Vaizdas", "REDIRECT|PERADRESAVIMAS"),
        _site("lvwiki", "Kategorija", "Palīdzība", "Attēls"),
        _site("hrwiki", "Kategorija", "Predložak", "Datoteka", "REDIRECT|PREUSMJERI"),
        replace(
            _EN, name="ruwiki", category_ns="Категория", template_ns="Шаблон", image_ns="Изображение", months=_RU_MONTHS, related_standalone=_RU_STANDALONE, related_inline=_RU_INLINE,
            override_templates=(("Template:Int:Lang", "ru"),), disambig_templates=_RU_DISAMBIG, disambig_title=r"\(значения\)", redirect=_redirect("REDIRECT"),
        ),
        replace(_EN, name="wikinvest", image_ns="Image", aliases=(), content_ns=("Stock", "Metric", "Concept", "Industry"), redirect=_redirect("REDIRECT")),
    )
}
