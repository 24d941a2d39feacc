"""Fixed values of the incident-post domain.

Everything here is data: word lists, lookup tables, patterns, seed rows and column
formats whose exact spelling (and, where stated, order) decides the results. The
column expressions that use them live in ``roadlark.functions``.
"""

# ---- fixed values: words -------------------------------------------------------

NUMBER_WORDS = {
    "ZERO": 0, "ONE": 1, "TWO": 2, "THREE": 3, "FOUR": 4, "FIVE": 5,
    "SIX": 6, "SEVEN": 7, "EIGHT": 8, "NINE": 9, "TEN": 10,
}

VEHICLE_PLURALS = {
    "MOTORCYCLES": "MOTORCYCLE", "CARS": "CAR", "VANS": "VAN", "BUSES": "BUS",
    "TRUCKS": "TRUCK", "SUVS": "SUV", "SUV'S": "SUV", "JEEPNEYS": "JEEPNEY",
    "TAXIS": "TAXI",
}

VEHICLE_ALIASES = {
    "PICKUP": "PICK-UP", "PICK UP": "PICK-UP", "PICK- UP": "PICK-UP",
    "PICK -UP": "PICK-UP", "EJEEP:": "E-JEEP", "E- JEEP": "E-JEEP",
    "E -JEEP": "E-JEEP",
}

ARTICLES = ["A", "AN"]

POST_MARK = "MMDA ALERT"

# Characters trimmed from both ends of a text (Unicode white space and the
# information separators).
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# ---- fixed values: patterns ----------------------------------------------------
# Java syntax. White space and word characters are spelt out, because the shorthands
# know ASCII only unless (?U) is set, which is several times slower, and because \b
# changed its meaning between Java versions. (?d) lets "." stop at \n only.

# The leading [^!-~] rejects printable ASCII at once.
_S = (
    r"[[^!-~]&&[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]"
)
_W = r"[A-Z0-9_\p{L}\p{N}]"
_START, _END = f"(?<!{_W})", f"(?!{_W})"


def _word(choices: str, first: str) -> str:
    """Whole word out of ``choices``; ``first`` lists their first characters, a quick
    test that spares the look-behind at most positions."""
    return f"(?=[{first}]){_START}({choices}){_END}"


# What keeps a text from being plain: anything but printable ASCII and the blank.
FOREIGN_PATTERN = "[^ -~]"


def plain(pattern: str) -> str:
    """A pattern of this module for plain texts: there the blank is the only white space and
    a word character an ASCII one, and tests for these are several times faster."""
    return pattern.replace(_S, " ").replace(_W, "[A-Za-z0-9_]")


DIRECTION_TOKENS = "NB|SB|EB|WB|NORTHBOUND|SOUTHBOUND|EASTBOUND|WESTBOUND"
PLACE_WORDS = "AT|ALONG|ON"
NUMBERS = "|".join(NUMBER_WORDS)

DIRECTION_PATTERN = _word(DIRECTION_TOKENS, "NSEW")
TIME_PATTERN = rf"(?=[0-9]){_START}([0-9]{{1,2}})(?::{_S}*([0-9]{{2}}))?{_S}*(AM|PM){_END}"
LANES_PATTERN = rf"(?=[0-9ZOTFSEN]){_START}([0-9]+|{NUMBERS}){_S}+LANES?{_END}"
LANES_HINT = "LANE"
TYPE_PATTERN = rf"(?d){POST_MARK}:{_S}*(.*?){_S}+({PLACE_WORDS}){_END}"
LOCATION_PATTERN = (
    rf"(?d)(?=[AO]){_START}({PLACE_WORDS}){_S}+(.*?)"
    rf"(?={_S}+(?:INVOLVING|STALLED|{DIRECTION_TOKENS}|MORE OR|AS OF|$))"
)
LOCATION_TAIL_PATTERN = rf"(?d){_START}INVOLVING{_END}.*$"
LOCATION_TAIL_HINT = "INVOLVING"
PARTICIPANTS_PATTERN = rf"(?d)INVOLVING{_S}+(.*?){_S}*(?={_S}+(?:AS OF|OF|MORE OR|$))"
RALLY_LOCATION_PATTERN = rf"(?d)({PLACE_WORDS}){_S}+(.*?){_S}+MORE OR{_END}"
RALLY_COUNT_PATTERN = rf"MORE OR LESS{_S}+([0-9]+){_S}+PAX{_END}"
STALLED_PATTERN = rf"(?d)STALLED{_S}+(.*?){_S}+DUE{_END}"
WHEELER_PATTERN = rf"([0-9]{{1,2}}){_S}*(WHEELER TRUCK)"
WHEELER_HINT = "WHEELER TRUCK"
COUNTED_PATTERN = rf"(?d)^([0-9]+){_S}+(.+)$"
ARTICLE_PATTERN = _word("|".join(reversed(ARTICLES)), "A")
NUMBER_WORD_PATTERN = _word(NUMBERS, "ZOTFSEN")
AND_PATTERN = _word("AND", "A")
SPACES_PATTERN = rf"{_S}+"


def whole_word(word: str) -> str:
    return f"{_START}{word}{_END}"


RALLY_WORD = "RALLY"
STALLED_WORD = "STALLED"

# Accepted texts of a post date: shape -> format.
DATE_FORMATS = {
    r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$": "yyyy-M-d",
    r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$": "yyyy-M-d H:m:s",
    r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$": "M/d/yyyy",
    r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$": "M/d/yyyy H:m:s",
}

# ---- fixed values: spelling rules of place names -------------------------------
# Literal replacements applied one after the other; the order decides the result,
# and repeated rows are meant (earlier rows create new matches for later ones).

LOCATION_RULES = [
    (" AT ", ""),
    (" IN FRONT OF ", " "),
    (" TOWARDS ", " "),
    (" GOING ", " "),
    (" COMMONWEALTH, ", " COMMONWEALTH "),
    (" COMMO ", " COMMONWEALTH "),
    (" AFTER ", " "),
    (" AS OF", ""),
    ("TIRE ", ""),
    ("F/O", "FLYOVER"),
    (" FO ", " FLYOVER "),
    (" AVE ", " AVE. "),
    ("AVE,", "AVE."),
    (" AVENUE ", " AVE. "),
    ("BLVD", "BLVD."),
    (" BOULEVARD ", " BLVD. "),
    (" SCT ", " SCT. "),
    (", ", " "),
    (",", ""),
    (" OLD BALARA ", " MATANDANG BALARA "),
    ("SGT.ESGUERRA", "SGT. ESGUERRA"),
    ("SVC.", "SERVICE"),
    (" SVC ", " SERVICE "),
    ("P.TUAZON", "P. TUAZON"),
    (" A BONI ", " A BONIFACIO "),
    (" A.BONIFACIO ", " A BONIFACIO "),
    (" A. BONI ", " A BONIFACIO "),
    ("P.OCAMPO", "P. OCAMPO"),
    ("B.SERRANO", "B. SERRANO"),
    ("BONI SERRANO", "B. SERRANO"),
    ("BONNI SERRANO", "B. SERRANO"),
    (" T.SORA ", " TANDANG SORA "),
    (" T. SORA ", " TANDANG SORA "),
    ("MC ARTHUR", "MCARTHUR"),
    (" MHW ", " MARCOS HIGHWAY "),
    (" RMB ", " RAMON MAGSAYSAY BLVD "),
    ("P TUAZON", "P. TUAZON"),
    (" C-5 ", " C5 "),
    (" C-3 ", " C3 "),
    ("C.P ", "C.P. "),
    (" CP ", " C.P. "),
    (" CP. ", " C.P. "),
    ("HI-WAY ", "HIGHWAY "),
    ("ROBINSON ", "ROBINSONS "),
    (" CORNER ", " "),
    (" COR ", " "),
    (" COR. ", " "),
    (" FRONTING ", " "),
    (" INFRONT OF ", " "),
    (" INFRONT ", " "),
    (" IN FRONT OF ", " "),
    (" FRONT OF ", " "),
    (" BEFORE ", " "),
    (" AFTER ", " "),
    ("AFTER ", ""),
    (" GOING ", " "),
    (" SPLIT ", " "),
    (" INTERSECTION ", " "),
    (" INTERSECTION", " "),
    (" INT. ", " "),
    (" INT ", " "),
    (" INT", " "),
    (" APPROACHING ", " "),
    ("  ", " "),
    ("..", "."),
    (" U-TURN SLOT ", " UTS "),
    (" U-TURN ", " UTS "),
    (" U-TURN", " UTS"),
    (" SVC ", " SVC. "),
    (" RD. ", " ROAD "),
    (" SERVICE ROAD ", " "),
    (" SVC. ROAD ", " "),
    ("\n", " "),
    (". ", " "),
    (".", ""),
    ("  ", " "),
]

# ---- fixed values: places ------------------------------------------------------

CITY_SUFFIXED = ["Pasay", "Pasig", "Makati"]
CITY_SUFFIX = " City"
CITY_RESPELLED = {"Kalookan City": "Caloocan City"}
CITY_PATTERNS = {"Para.*aque": "Paranaque"}
CONFIDENCE_SCORES = {"High": 1.0, "Medium": 0.5, "Low": 0.0}
RESOLVER_BATCH = 95

# ---- fixed values: event types, defaults ---------------------------------------

EVENT_TYPE_RULES = [
    ("STALLED%", "STALLED VEHICLE"),
    ("ROAD%", "ROAD CRASH"),
    ("VEHICULAR%", "ACCIDENT"),
    ("%COLLISION%", "MULTIPLE COLLISION"),
    ("RALLY%", "RALLY"),
]
EVENT_TYPE_DEFAULT = "OTHERS"
UNKNOWN = "UNKNOWN"
NO_SUGGESTION = "NONE"
CONTAINMENT_BONUS = 0.15

# ---- fixed values: timeline pages ----------------------------------------------

PAGE_DATE_SEPARATOR = " · "
PAGE_DATE_FORMAT = "MMM d, yyyy"
LINK_HOSTS = ("nitter.net", "x.com")
PAGE_BASE = "https://nitter.net"
PAGE_ACCOUNT = "MMDA"

# ---- fixed values: seed rows ---------------------------------------------------

SEED_DIRECTIONS = [
    ("NB", "NORTHBOUND"),
    ("SB", "SOUTHBOUND"),
    ("EB", "EASTBOUND"),
    ("WB", "WESTBOUND"),
]

# (vehicle type, group); every seed is verified and was suggested from nothing.
SEED_VEHICLES = [
    ("TRUCK", "COMMERCIAL"),
    ("ELF TRUCK", "COMMERCIAL"),
    ("BUS", "PUBLIC"),
    ("AMBULANCE", "PUBLIC"),
    ("L300", "COMMERCIAL"),
    ("DELIVERY VAN", "COMMERCIAL"),
    ("TRAILER", "COMMERCIAL"),
    ("16-WHEELER TRUCK", "COMMERCIAL"),
    ("10-WHEELER TRUCK", "COMMERCIAL"),
    ("DUMP TRUCK", "COMMERCIAL"),
    ("PEDESTRIAN", "NON-VEHICLE"),
    ("AUV", "PRIVATE"),
    ("CAR", "PRIVATE"),
    ("SUV", "PRIVATE"),
    ("PICK-UP", "PRIVATE"),
    ("VAN", "PRIVATE"),
    ("CLOSED VAN", "COMMERCIAL"),
    ("MC", "PRIVATE"),
    ("INNOVA", "PRIVATE"),
    ("MOTORCYCLE", "PRIVATE"),
    ("HI-ACE VAN", "PRIVATE"),
    ("UV EXPRESS", "PUBLIC"),
    ("PUJ", "PUBLIC"),
    ("TAXI", "PUBLIC"),
    ("MINI BUS", "PUBLIC"),
    ("UV", "PUBLIC"),
    ("MODERN JEEPNEY", "PUBLIC"),
    ("E-JEEP", "PUBLIC"),
]
