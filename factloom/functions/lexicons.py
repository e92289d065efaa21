"""Word lists of this engine's own; every list is configuration and can be replaced."""

from __future__ import annotations

COMPANY_SUFFIXES = ("incorporated", "inc", "corporation", "corp", "company", "co", "limited", "ltd", "plc", "llc", "group", "holdings")

# Suffixes that a plain name loses, and words that are noise as a chain's end.
PLAIN_SUFFIXES = ("inc", "llc", "corp", "ltd", "company")
NOISE_WORDS = (
    "he", "she", "they", "it", "we", "his", "her", "their", "its", "this", "that", "these", "those", "one", "two", "three",
    "new", "old", "first", "last", "next", "other", "same", "many", "some", "all", "both", "each", "every", "any",
)

#: (kind, key words); the first kind with a key word in the name counts.
ENTITY_KEYS = (
    ("university", ("university", "college", "academy", "institute")),
    ("railway", ("railway", "railroad")),
    ("bank", ("bank", "trust", "insurance")),
    ("newspaper", ("times", "herald", "gazette", "journal")),
    ("museum", ("museum", "library", "gallery")),
    ("event", ("war", "treaty", "battle", "congress")),
    ("company", ("inc", "corp", "ltd", "brand", "works", "supplier", "customer")),
    ("place", ("city", "county", "river", "united ", "kingdom")),
)

#: (context, key words); the first context with a key word in the sentence counts.
CONTEXT_KEYS = (
    ("UI", ("click", "cookie", "log in", "subscribe", "menu")),
    ("CORPORATE", ("acquir", "merge", "company", "stake", "founded")),
    ("BIOGRAPHICAL", ("born", "married", "died", "son of", "daughter of")),
    ("SCIENTIFIC", ("discover", "experiment", "theory", "invent")),
    ("HISTORICAL", ("century", "war", "treaty", "empire")),
)

PHRASES = {"ACQUIRED": "took over", "RELEASED": "brought out", "LOCATED_IN": "has its seat in", "WAS_ROLE_OF": "held a post at", "LED_TO": "resulted in", "FOUNDED": "set up"}

FOUNDING = ("FOUNDED", "ESTABLISHED", "CREATED", "RELEASED")
SINGLE_TARGET = ("LOCATED_IN", "FOUNDED", "RELEASED")
GENERIC_ANSWERS = ("company", "group", "people", "market", "other", "unknown", "none", "page", "view", "error")
BAD_ANSWER_PARTS = ("click", "cookie", "http", "null", "undefined", "subscribe", "privacy")
PRONOUNS = ("he", "she", "it", "they", "we", "who", "this", "that", "these", "those", "i", "you")
VERBS = {"acquire": "ACQUIRED", "buy": "ACQUIRED", "found": "FOUNDED", "establish": "FOUNDED", "release": "RELEASED", "publish": "RELEASED", "open": "OPENED", "build": "BUILT", "sell": "SOLD", "lead": "LED", "invent": "INVENTED", "join": "JOINED"}
CONNECTIVES = ("resulted in", "led to", "gave rise to", "brought about", "paved the way for")

REJECTED_ENDINGS = ("pdf", "zip", "gz", "exe", "mp3", "mp4", "avi", "jpg", "jpeg", "png", "gif", "svg", "css", "js", "xml", "csv", "doc", "docx")
DELIVERY_PARTS = ("/download/", "/cdn/", "/static/", "/assets/")
BLOCKED_DOMAINS = ("casino-win.example.org", "cheap-pills.example.com", "spam-farm.example.org", "ads-track.example.org")
#: Parts of a URL that mark pages without prose: deliveries, binaries, forms.
SKIPPED_PARTS = ("/download/", "/stream/", "/serve/", ".epub", ".mobi", ".zip", ".gz", ".torrent", ".tiff", ".djvu", "page=2")
#: What to search for, by relation; others take both names and the relation.
SEARCHES = {"ACQUIRED": "{A} acquisition of {B}", "RELEASED": "{A} release {B}", "LOCATED_IN": "{A} location {B}"}
FEED_PATHS = ("/feed", "/rss", "/api", "/wp-json")
NOISY_PARTS = ("/login", "/cart", "/tag/")
ALLOWED_DOMAINS = ("thther.example.org", "ththen.example.com", "blog.ththon.example.net")
RATE_LIMITS = {"thther.example.org": 1.0, "ththen.example.com": 4.0}
STOP_WORDS = ("the", "and", "with", "from", "that", "this", "which", "what", "when", "where", "were", "was")
