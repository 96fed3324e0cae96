
from __future__ import annotations

import functools
from functools import reduce
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F


def nz(c: Column | str) -> Column:
    """PRJ-01: empty text as NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.trim(c) != "", c)


def first_of(*cols: Column | str, default: str | None = None) -> Column:
    """PRJ-01, PRJ-03: first non-empty of several."""
    found = [nz(c) for c in cols]
    return F.coalesce(*found, F.lit(default)) if default is not None else F.coalesce(*found)


def upper_enum(c: Column | str, default: str) -> Column:
    """PRJ-02."""
    return F.upper(first_of(c, default=default))


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def clean(c: Column) -> Column:
    """STR-01: white space squeezed, punctuation off both ends."""
    return F.btrim(squeeze(c), F.lit(" \t\r\n.,;:!?()[]{}\"'"))


def norm_tokens(c: Column) -> Column:
    """STR-02: [a-z0-9]+ tokens joined by one space."""
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))


def norm_handle(c: Column) -> Column:
    """STR-03: like STR-02 with @ . _ ' - kept."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), r"[^a-z0-9@._' -]+", " "), r"\s+", " "))


def norm_caption_token(c: Column) -> Column:
    """STR-03: a caption token's comparable form; the token in lower case where nothing would be left."""
    low = F.replace(F.lower(c), F.lit("’"), F.lit("'"))
    return F.coalesce(nz(F.regexp_replace(low, r"[^a-z0-9@_'-]+", "")), F.trim(low))


def safe_name(c: Column) -> Column:
    """STR-05."""
    return F.regexp_replace(c, "[^A-Za-z0-9._-]", "_")


def sentences(c: Column) -> Column:
    """STR-04: cut after . ! ? where white space and a capital, digit, quote or bracket follow."""
    return F.split(c, r"(?<=[.!?])\s+(?=[A-Z0-9\"'(\[])")


# Web addresses, and bare domains with a well-known ending.
URL = r"https?://[^\s<>\"']+|\b(?:www\.)?[A-Za-z0-9.-]+\.(?:com|org|net|io|tv|news|co|us|gov|edu)\b"
CHANNEL_TABS = ["/videos", "/shorts", "/streams", "/featured"]
CHANNEL_PATHS = ["/@", "/channel/", "/c/", "/user/"]


def urls(c: Column) -> Column:
    """STR-08."""
    return F.regexp_extract_all(c, F.lit(f"(?i)(?:{URL})"), F.lit(0))


def url_root(c: Column) -> Column:
    """STR-07: struct(root, is_channel). A channel's address loses its tab and query; watch pages, playlists and addresses
    of other hosts stay as they are but for closing slashes."""
    u = F.regexp_replace(F.trim(c), "/+$", "")
    part = lambda i: F.coalesce(F.regexp_extract(u, r"^([a-zA-Z][a-zA-Z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?", i), F.lit(""))
    path = F.regexp_replace(part(3), "/+$", "")
    cut = F.regexp_replace(path, "(?:" + "|".join(CHANNEL_TABS) + ")$", "")
    other = ~F.lower(part(2)).contains("youtube.com") | cut.isin("/watch", "/playlist") | part(4).contains("list=")
    root = F.when(other, u).otherwise(F.regexp_replace(F.concat(part(1), F.lit("://"), part(2), cut), "/+$", ""))
    channel = reduce(lambda a, p: a | cut.startswith(p), CHANNEL_PATHS[1:], cut.startswith(CHANNEL_PATHS[0]))
    return F.struct(root.alias("root"), (~other & channel).alias("is_channel"))


def run_stamp(now: Column) -> Column:
    """DTE-02: a time as the name of a run."""
    return F.date_format(now, "yyyyMMdd'T'HHmmss'Z'")


REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;?)"


@functools.lru_cache(maxsize=1)
def _named() -> tuple[dict[str, str], list[str]]:
    """HTML's named references (the standard library's table): those with a semicolon, and the names that do without, longest first."""
    names = {k.removesuffix(";"): v for k, v in html5.items()}
    return names, sorted((k for k in html5 if not k.endswith(";")), key=lambda k: (-len(k), k))


def _quoted(x: str) -> str:
    return "'" + "".join(f"\\u{ord(c):04x}" if ord(c) < 0x10000 else f"\\U{ord(c):08x}" for c in x) + "'"


def _reference(m: Column) -> Column:
    """What a match of REFERENCE stands for, by HTML's rules; what stands for nothing stays as it is."""
    names, bare = _named()
    table = F.expr(f"map({', '.join(f'{_quoted(k)}, {_quoted(v)}' for k, v in names.items())})")
    short = F.expr(f"array({', '.join(_quoted(k) for k in bare)})")
    body = F.regexp_replace(m, "^&#?[xX]?|;$", "")
    hexed = m.rlike("^&#[xX]")
    digits = F.regexp_replace(body, "^0+", "")
    huge = F.length(digits) > F.when(hexed, 6).otherwise(7)
    code = F.when(huge, F.lit(0x110000)).when(hexed, F.conv(F.concat(F.lit("0"), digits), 16, 10).cast("int")).otherwise(F.concat(F.lit("0"), digits).cast("int"))
    # codes of the old Western set stand for its characters; some codes for none
    old = F.expr(f"map({', '.join(f'{c}, {_quoted(bytes([c]).decode("cp1252"))}' for c in range(0x80, 0xA0) if c not in (0x81, 0x8D, 0x8F, 0x90, 0x9D))})")
    plane = code.bitwiseAND(0xFFFF)
    none = code.between(1, 8) | code.between(0x0E, 0x1F) | (code == 0x0B) | code.between(0xFDD0, 0xFDEF) | plane.isin(0xFFFE, 0xFFFF)
    lost = code.isin(0x81, 0x8D, 0x8F, 0x90, 0x9D) | (code == 0x7F)
    bad = (code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(code.cast("long")), 8, "0")), "UTF-32")
    number = F.when(bad, "\ufffd").when(code == 0x0D, "\r").when(lost & (code != 0x7F), char).when(F.try_element_at(old, code).isNotNull(), F.try_element_at(old, code)).when(none | lost, "").otherwise(char)
    name = F.substring(m, 2, 64)
    whole = F.when(m.endswith(";"), F.try_element_at(table, F.regexp_replace(name, ";$", "")))
    head = F.get(F.filter(short, lambda k: name.startswith(k)), F.lit(0))
    cut = F.concat(F.try_element_at(table, head), F.substr(name, F.length(head) + 1))
    return F.when(m.startswith("&#"), number).otherwise(F.coalesce(whole, cut, m))


def references(c: Column) -> Column:
    """STR-06: character references decoded, named and numeric, once."""
    gaps, found = F.split(c, REFERENCE, -1), F.regexp_extract_all(c, F.lit(REFERENCE), F.lit(0))
    decoded = F.transform(found, _reference)
    joined = F.concat(F.get(gaps, F.lit(0)), F.array_join(F.zip_with(decoded, F.slice(gaps, 2, F.greatest(F.size(gaps), F.lit(1))), lambda d, g: F.concat(d, g)), ""))
    return F.when(F.contains(c, F.lit("&")), joined).otherwise(c)


def unescape(c: Column) -> Column:
    """STR-06: tags off, character references decoded."""
    return references(F.regexp_replace(c, "<[^>]*>", ""))


def stable_id(prefix: str, *parts: Column, n: int = 24, sep: str = "\x1f", lower: bool = False) -> Column:
    """STR-10 ... STR-13: prefix and the first n hex digits of the SHA-256 of the parts; NULL parts are empty."""
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    texts = [squeeze(F.lower(t)) for t in texts] if lower else texts
    return F.concat(F.lit(prefix), F.upper(F.substring(F.sha2(F.concat_ws(sep, *texts), 256), 1, n)))


def snippet(text: Column, start: Column, length: Column, around: int = 160) -> Column:
    """STR-15: text around a span; start counts from 0."""
    lo = F.greatest(F.lit(0), start - around)
    return F.substring(text, (lo + 1).cast("int"), (start + length + around - lo).cast("int"))


def tail(c: Column, n: int) -> Column:
    """STR-16."""
    return F.right(c, F.lit(n))


def date_with_precision(c: Column) -> Column:
    """DTE-01: struct(ts, date, precision) of epoch seconds, YYYYMMDD or nothing."""
    day, epoch = F.try_to_timestamp(F.when(F.length(c) == 8, c), F.lit("yyyyMMdd")), F.try_to_number(c, F.lit("99999999999999"))
    ts = F.when(F.length(c) != 8, F.timestamp_seconds(epoch.cast("double")))
    return F.struct(ts.alias("ts"), F.coalesce(ts, day).cast("date").alias("date"), F.when(ts.isNotNull(), "TIMESTAMP").when(day.isNotNull(), "DATE").otherwise("UNKNOWN").alias("precision"))


def vtt_seconds(c: Column) -> Column:
    """DTE-03: [hh:]mm:ss.mmm in seconds."""
    parts = F.reverse(F.split(F.replace(c, F.lit(","), F.lit(".")), ":"))
    at = lambda i: F.coalesce(F.get(parts, F.lit(i)).try_cast("double"), F.lit(0.0))
    return at(0) + at(1) * 60 + at(2) * 3600


def lease_until(now: Column, seconds: Column) -> Column:
    """DTE-04: now and 30 seconds at least."""
    return F.timestamp_add("SECOND", F.greatest(F.lit(30), seconds).cast("int"), now)


# Base weight of a relationship by its type; others weigh 1.
EDGE_WEIGHTS = {
    "OWNS": 10.0, "CONTROLS": 10.0, "FINANCIAL": 9.0, "PAYS": 9.0, "FUNDS": 9.0, "INVESTS_IN": 9.0, "EMPLOYS": 8.0, "OFFICER": 8.0, "DIRECTOR": 8.0,
    "BOARD_MEMBER_OF": 8.0, "FORMAL_PROFESSIONAL": 7.0, "CONTRACTS_WITH": 7.0, "JOINT_PRODUCT": 7.0, "SPONSORSHIP": 6.0, "AFFILIATE_REFERRAL": 6.0,
    "SELLS": 5.0, "MANUFACTURES": 5.0, "DISTRIBUTES": 5.0, "LICENSES": 5.0, "COMMERCIAL_PROMOTION": 4.0, "COAUTHORS": 4.0, "COPRODUCES": 4.0,
    "RECURRING_MEDIA": 3.0, "RECURRING_CONFERENCE": 2.5, "SINGLE_MEDIA": 1.0, "SINGLE_CONFERENCE": 0.8, "IDEOLOGICAL_TOPICAL": 0.0,
}
# Multiplier by confidence; others 0.85.
CONFIDENCE = {"HIGH": 1.0, "VERIFIED": 1.0, "MEDIUM": 0.8, "LOW": 0.55}


def lookup(c: Column, table: dict[str, float], default: float) -> Column:
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, c), F.lit(default))


def edge_weight(kind: Column, confidence: Column, evidence: Column, primary: Column) -> Column:
    """MTH-01."""
    base, conf = lookup(F.upper(F.coalesce(kind, F.lit(""))), EDGE_WEIGHTS, 1.0), lookup(F.upper(F.coalesce(confidence, F.lit(""))), CONFIDENCE, 0.85)
    ev, pr = F.greatest(F.lit(1.0), F.coalesce(evidence.cast("double"), F.lit(1.0))), F.coalesce(primary.cast("double"), F.lit(0.0))
    return base * conf * (1 + F.least(F.lit(1.5), F.ln(1 + ev) / 3) + F.least(F.lit(0.5), 0.08 * pr))


def bridge_score(participation: Column, strength: Column) -> Column:
    """MTH-03."""
    return participation * F.ln(1 + strength)


def cosine(a: Column, b: Column) -> Column:
    """MTH-05: 0 for a zero vector, within [-1, 1]."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(size > 0, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot(a, b) / size))).otherwise(0.0)


def motif_strength(relations: Column, a: Column, b: Column, content_a: Column, content_b: Column) -> Column:
    """MTH-06."""
    return F.bround(F.least(F.lit(100.0), 12 * (1.5 * F.ln(1 + relations) + F.ln(1 + a) + F.ln(1 + b) + 0.5 * F.ln(1 + content_a + content_b))), 2)


def triage_score(canonical: Column, kind: Column, signals: Column, known: Column, mentions: Column, contents: Column, speakers: Column) -> Column:
    """MTH-07, TXT-11. signals: array of signal names."""
    has = lambda p: F.exists(signals, lambda s: s.startswith(p))
    on = lambda c, n: F.when(c, n).otherwise(0)
    terms = on(canonical, 100) + on(kind == "website", 30) + on(known, 100) + on(has("url"), 25) + on(has("cue_"), 25) + on(has("proper"), 8)
    return terms + F.least(F.lit(20), 2 * mentions) + F.least(F.lit(30), 5 * contents) + F.least(F.lit(10), 2 * speakers)


def priority(score: Column, existing: Column) -> Column:
    """TXT-11."""
    return F.when(existing, "EXISTING").when(score >= 45, "HIGH").when(score >= 25, "MEDIUM").otherwise("LOW")


def priority_rank(p: Column) -> Column:
    """SRT-01: EXISTING, HIGH, MEDIUM, LOW."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in (("EXISTING", 0), ("HIGH", 1), ("MEDIUM", 2), ("LOW", 3)) for x in kv]), p), F.lit(4))


def overlap_suffix_prefix(a: Column, b: Column, most: int) -> Column:
    """ARR-02: the largest k up to `most` for which the last k of a are the first k of b."""
    n = F.least(F.size(a), F.size(b), F.lit(most))
    fits = F.filter(F.sequence(F.lit(0), n), lambda k: (k == 0) | (F.slice(a, F.when(k > 0, F.size(a) - k + 1).otherwise(1), k) == F.slice(b, 1, k)))
    return F.coalesce(F.array_max(fits), F.lit(0))


def json_array(c: Column, kind: str = "string") -> Column:
    """JSN-01: [] for what is no JSON array."""
    return F.coalesce(F.from_json(c, f"array<{kind}>"), F.expr(f"cast(array() as array<{kind}>)"))


def resolve_refs(refs: Column, table: Column) -> Column:
    """JSN-04: local ids to stable ids through a map; unknown ones go."""
    return F.filter(F.transform(refs, lambda r: F.try_element_at(table, r)), lambda x: x.isNotNull())


# Failure classes in order, the first that matches counts. "pot" counts as a word only.
FAILURES = [
    ("HTTP_403", r"HTTP Error 403|HTTP 403|403 Forbidden"),
    ("PO_TOKEN", r"PO Token|Proof of Origin|\bpot\b"),
    ("ONLY_IMAGES", r"Only images are available|only images"),
    ("NO_FORMAT", r"Requested format is not available|No video formats found|no formats"),
    ("SIGN_IN", r"Sign in to confirm|login required|age-restricted"),
    ("RATE_LIMIT", r"429|Too Many Requests|rate limit"),
    ("FRAGMENT_FAIL", r"fragment|Unable to download video data|failed to download"),
    ("FFMPEG", r"ffmpeg|Invalid data found|Error while decoding"),
]


def failure_class(c: Column) -> Column:
    """STR-14."""
    text = F.coalesce(c, F.lit(""))
    return reduce(lambda w, x: w.when(text.rlike(f"(?i){x[1]}"), x[0]), FAILURES[1:], F.when(text.rlike(f"(?i){FAILURES[0][1]}"), FAILURES[0][0])).otherwise("OTHER")


def truthy(c: Column) -> Column:
    return F.lower(F.trim(c.cast("string"))).isin("true", "1", "yes", "y")
