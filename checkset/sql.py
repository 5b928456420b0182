"""SQL fragments the twins share."""

SPACES = (
    r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)
MARKUP = (
    r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script[^>]*>|<style\b[^>]*>.*?</style[^>]*>"
    r"|<[a-z/!?][^>]*>"
)


def norm_ws(text: str) -> str:
    return f"trim(regexp_replace({text}, '{SPACES}', ' ', 'g'))"


def entities(text: str) -> str:
    # The semicolon may be missing: a name ends where its letters do.
    for name, char in [("middot", "·"), ("copy", "©"), ("quot", '"'), ("amp", "&")]:
        text = rf"regexp_replace({text}, '&{name}(;|\b)', '{char}', 'g')"
    return text


def clean_html(html: str) -> str:
    # A character no text holds keeps references from running into the next text.
    gaps = entities(f"regexp_replace({html}, '{MARKUP}', chr(65535), 'g')")
    return norm_ws(f"replace({gaps}, chr(65535), '')")


def element(html: str, pattern: str) -> str:
    return clean_html(f"regexp_extract({html}, '{pattern}', 1)")


def elements(html: str, pattern: str) -> str:
    found = f"regexp_extract_all({html}, '{pattern}', 1)"
    return f"list_transform({found}, lambda e: {clean_html('e')})"


def distinct(items: str) -> str:
    """First occurrence of each item; ``items`` must be a column."""
    return f"list_filter({items}, lambda x, i: list_position({items}, x) = i)"


def last(items: str) -> str:
    return f"coalesce(({items})[-1], '')"
