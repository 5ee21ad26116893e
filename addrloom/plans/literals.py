"""Fixed values of the comparison SQL, written out on their own: nothing here comes from the module that the engine uses."""

US_STATES = [
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DC", "DE", "FL", "GA", "HI", "IA", "ID", "IL", "IN", "KS", "KY", "LA", "MA", "MD", "ME", "MI", "MN", "MO", "MS",
    "MT", "NC", "ND", "NE", "NH", "NJ", "NM", "NV", "NY", "OH", "OK", "OR", "PA", "RI", "SC", "SD", "TN", "TX", "UT", "VA", "VT", "WA", "WI", "WV", "WY",
]
TERRITORIES = ["AS", "FM", "GU", "MH", "MP", "PR", "PW", "VI"]
MILITARY = ["AA", "AE", "AP"]
PROVINCES = ["AB", "BC", "MB", "NB", "NL", "NS", "NT", "NU", "ON", "PE", "QC", "SK", "YT"]
ADDRESS_RATIO, COST_PER_PIECE = 0.85, 0.65

STREET_SHORT = {
    "ST": "ST", "STREET": "ST", "AVE": "AVE", "AV": "AVE", "AVENUE": "AVE", "RD": "RD", "ROAD": "RD", "DR": "DR", "DRIVE": "DR", "BLVD": "BLVD", "BOULEVARD": "BLVD",
    "LN": "LN", "LANE": "LN", "CT": "CT", "COURT": "CT", "CIR": "CIR", "CIRCLE": "CIR", "PKWY": "PKWY", "PARKWAY": "PKWY", "HWY": "HWY", "HIGHWAY": "HWY",
    "PL": "PL", "PLACE": "PL", "TER": "TER", "TERRACE": "TER", "WAY": "WAY", "TRL": "TRL", "TRAIL": "TRL", "EXPY": "EXPY", "EXPRESSWAY": "EXPY", "LOOP": "LOOP",
    "SQ": "SQ", "SQUARE": "SQ", "ALY": "ALY", "ALLEY": "ALY", "RUN": "RUN", "PATH": "PATH", "PASS": "PASS",
}
STREET_DISPLAY = {
    "ST": "St.", "STREET": "St.", "AVE": "Ave.", "AV": "Ave.", "AVENUE": "Ave.", "RD": "Rd.", "ROAD": "Rd.", "DR": "Dr.", "DRIVE": "Dr.", "BLVD": "Blvd.",
    "BOULEVARD": "Blvd.", "LN": "Ln.", "LANE": "Ln.", "CT": "Ct.", "COURT": "Ct.", "CIR": "Cir.", "CIRCLE": "Cir.", "PKWY": "Pkwy.", "PARKWAY": "Pkwy.",
    "HWY": "Hwy.", "HIGHWAY": "Hwy.", "PL": "Pl.", "PLACE": "Pl.", "TER": "Ter.", "TERRACE": "Ter.", "WAY": "Way", "TRL": "Trl.", "TRAIL": "Trl.",
    "EXPY": "Expy.", "EXPRESSWAY": "Expy.", "LOOP": "Loop", "SQ": "Sq.", "SQUARE": "Sq.", "ALY": "Aly.", "ALLEY": "Aly.", "RUN": "Run", "PATH": "Path", "PASS": "Pass",
}
DIRECTION_SHORT = {
    "N": "N", "NORTH": "N", "S": "S", "SOUTH": "S", "E": "E", "EAST": "E", "W": "W", "WEST": "W", "NE": "NE", "NORTHEAST": "NE", "NW": "NW", "NORTHWEST": "NW",
    "SE": "SE", "SOUTHEAST": "SE", "SW": "SW", "SOUTHWEST": "SW",
}
DIRECTION_DISPLAY = {
    "N": "N.", "NORTH": "N.", "S": "S.", "SOUTH": "S.", "E": "E.", "EAST": "E.", "W": "W.", "WEST": "W.", "NE": "NE.", "NORTHEAST": "NE.", "NW": "NW.", "NORTHWEST": "NW.",
    "SE": "SE.", "SOUTHEAST": "SE.", "SW": "SW.", "SOUTHWEST": "SW.",
}
UNIT_DISPLAY = {
    "APT": "Apt", "APARTMENT": "Apt", "STE": "Ste.", "SUITE": "Ste.", "UNIT": "Unit", "RM": "Rm.", "ROOM": "Rm.", "BLDG": "Bldg.", "BUILDING": "Bldg.",
    "FL": "Fl.", "FLOOR": "Fl.", "#": "#", "LOT": "Lot", "SPC": "Spc.", "SPACE": "Spc.",
}
#: Longer spellings stand before those that they begin with.
UNIT_ORDER = {
    "APARTMENT": "APT", "APT": "APT", "BUILDING": "BLDG", "BLDG": "BLDG", "FLOOR": "FL", "FL": "FL", "LOT": "LOT", "ROOM": "RM", "RM": "RM", "SPACE": "SPC", "SPC": "SPC",
    "SUITE": "STE", "STE": "STE", "UNIT": "UNIT", "#": "#",
}

PO_BOX = r"(?i)\bP\.?\s*O\.?\s*BOX\b\s*[A-Z0-9][A-Z0-9\-]*|\bPOBOX\s*[A-Z0-9][A-Z0-9\-]*|\bPOB\b\s+[A-Z0-9][A-Z0-9\-]*"
PO_DRAWER = r"(?i)\b(?:P\.?\s*O\.?\s*BOX\b|POBOX|POB\b)\s*DRAWER\s+([A-Z0-9][A-Z0-9\-]*)"
PO_NUMBER = r"(?i)\b(?:P\.?\s*O\.?\s*BOX\b|POBOX|POB\b)\s*([A-Z0-9][A-Z0-9\-]*)"
RURAL = r"(?i)\b(RURAL\s+ROUTE|RR|R\.R\.|HIGHWAY\s+CONTRACT|HCR|HC)\s*(\d+)[,\s]+BOX\s+([A-Z0-9][A-Z0-9\-]*)"
MILITARY_BOX = r"(?i)\b(PSC|UNIT|CMR)\s+(\d+)\s+BOX\s+([A-Z0-9][A-Z0-9\-]*)"
#: RE2 has no look-behind: what stands before ``#`` is matched and then cut off.
UNIT_VALUE = r"(?i)(?:\b(?:STE|SUITE|UNIT|APT|APARTMENT|LOT|SPACE|SPC|BLDG|BUILDING|FL|FLOOR|RM|ROOM)|(?:^|[^A-Za-z0-9_])#)\s*([A-Z0-9\-]+)\b"
UNIT_TAIL = r"(?i)(?:,?\s*)(?:STE\.?|SUITE|UNIT|APT\.?|APARTMENT|LOT|SPACE|SPC\.?|BLDG\.?|BUILDING|FL\.?|FLOOR|RM\.?|ROOM|#)\s*[A-Z0-9][A-Z0-9\-]*\s*$"
ZIP4 = r"\b\d{5}[-\s]?\d{4}\b"
ORDINAL = r"^(\d+)(ST|ND|RD|TH)$"
STATE_ROUTE = r"(?i)\bST(?:ATE)?\s+ROUTE\b"
CARE_OF = r"(?i)\bC\s*/?\s*O\b"
INLINE_NULLS = [" - NULL", " - N/A", " - NONE", " NULL", " N/A"]
POSTAL_CODE = r"(?i)^([A-Z]\d[A-Z])(\d[A-Z]\d)$"
CITY_STATE_ZIP = r"(?i)(.+?)\s+([A-Z]{2})\s+(\d{5}(?:-\d{4})?)\s*$"
ONE_CITY_STATE_ZIP = r"(?i)^(.+?)\s+([A-Z]{2})\s+(\d{5}(?:-\d{4})?)\s*$"
NULL_ADDRESS = r"(?i)^\s*(?:NULL|N/?A|NONE|--?)\s*$"
NULL_NAME = r"(?i)^\s*(?:PENDING|NULL|N/?A|NONE|--?|\s*)\s*$"
NULL_PARCEL = r"(?i)^\s*(?:<?\s*Null\s*>?|PENDING|N/?A|NONE|--?|\s*)\s*$"
UNDELIVERABLE = (
    r"(?i)^\s*(?:mail\s+return(?:ed)?|return(?:ed)?\s+(?:mail|to\s+sender)|undeliverable|bad\s+address|no\s+(?:valid\s+)?address|no\s+forwarding\s+address"
    r"|unable\s+to\s+(?:forward|deliver)|attempted\s+not\s+known|(?:address\s+)?unknown|vacant|deceased|moved|refused|unclaimed)\s*$"
)
ROUTING_LINE = r"(?i)^\s*(?:C/?O|C\.\s*O\.|ATTN\.?|ATTENTION|IN\s+CARE\s+OF|CARE\s+OF|%)"
TRUST_TWICE = r"(?i)\bTrust\s+Trust\b"

TRUST_WORDS = ["CO-TR", "CO-TRS", "FAMILY TRUST", "LIVING TRUST", "REVOCABLE TRUST", "TR", "TR U/A", "TR UA", "TRS", "TRUST", "TRUSTEE", "TRUSTS"]
GOVERNMENT_PHRASES = [
    "BOARD OF", "CITY OF", "COUNTY OF", "FIRE DISTRICT", "IRRIGATION DISTRICT", "SCHOOL DISTRICT", "STATE OF", "TOWN OF", "U S GOVERNMENT", "UNIFIED SCHOOL DISTRICT",
    "UNITED STATES", "WATER DISTRICT",
]
GOVERNMENT_WORDS = ["AGENCY", "AUTHORITY", "BUREAU", "COMMISSION", "COUNCIL", "DEPARTMENT", "DEPT", "DISTRICT", "DIVISION"]
COMPANY_CAPITALS = ["CO", "CORP", "INC", "LLC", "LLP", "LP", "LTD", "PC", "PLC", "PLLC"]
COMPANY_TITLED = [
    "ASSOC", "ASSOCIATES", "CENTER", "CENTRE", "CHURCH", "COMPANY", "ENTERPRISES", "GROUP", "HOLDINGS", "HOSPITAL", "INVESTMENTS", "LODGE", "PARTNERS", "PARTNERSHIP",
    "PROPERTIES", "SCHOOL",
]
COMPANY_WORDS = [*COMPANY_CAPITALS, "L L C", *COMPANY_TITLED]
SMALL_WORDS = ["A", "AN", "AND", "AS", "AT", "BY", "FOR", "IN", "OF", "ON", "OR", "THE", "TO", "WITH"]
ENTITY_SIGNALS = ["&", "AND", "CORP", "INC", "LLC", "LTD", "TRUST"]
SUFFIXES = ["ESQ", "II", "III", "IV", "JR", "M.D", "MD", "PH.D", "PHD", "SR"]
TRANSACTION_TAIL = r"(?i)\b(?:PMT|PAYMENT)\s*#?\s*\d[\d\-/]*.*$|\bPERMIT\s+\d[\d\-/]*.*$|\b(?:APN|PARCEL)\s*#?\s*[\w\-/]+.*$"
LIFE_ESTATE = r"(?i)\b(?:LIFE\s+ESTATE|LIFE\s+EST\.?|L\.?\s*E\.?)\s*$"
SPACED = {r"(?i)\bL\s+L\s+L\s+P\b": "LLLP", r"(?i)\bP\s+L\s+L\s+C\b": "PLLC", r"(?i)\bL\s+L\s+C\b": "LLC", r"(?i)\bL\s+L\s+P\b": "LLP", r"(?i)\bL\s+T\s+D\b": "LTD", r"(?i)\bL\s+P\b": "LP"}
NAME_NOISE = r"(?i)\b(?:DO\s+NOT\s+MAIL|RETURN\s+TO\s+SENDER|RTS|PMT\s*#?\s*\d+|PAYMENT\s*#?\s*\d+|PERMIT\s+\d+|APN\s*#?\s*[\w\-/]+)\b.*$"
NAME_MARKS = r"[.,'`\"]+"
#: Words of up to three letters that are no acronyms.
SHORT_WORDS = (
    "ACE AGE AID AIM AIR ALL AND ANN ASK ATE AWE BAD BAN BAR BAT BED BEE BET BIG BIT BOW BOX BOY BUD BUG BUN BUS BUT CAN CAR CAT COP COT COW CRY CUB CUP "
    "CUT DAD DAM DAY DEE DEN DEW DIE DIG DIM DIP DOG DOT DRY DUE DUG EAR EAT EGG END ERA EVE EYE FAD FAN FAR FAT FED FEW FIG FIN FIR FIT FLY FOG FOR FOX "
    "FRY FUN FUR GAP GAS GEE GET GOD GOT GUM GUN GUT GUY HAD HAM HAS HAT HER HID HIM HIS HIT HOG HOP HOT HOW HUB HUG HUT ICE ILL INK INN IRE ITS JAM JAR "
    "JAW JET JOB JOG JOY JUG KAY KEY KID KIT LAD LAP LAW LAY LED LEE LEG LET LID LIE LIT LOG LOT LOW MAD MAE MAN MAP MAT MAY MEN MET MIX MOB MOM MOP MUD "
    "MUG NAP NET NEW NOD NOR NOT NOW NUT OAK OAT ODD OIL OLD ONE ORE OUR OUT OWE OWL OWN OZ PAD PAN PAT PAW PAY PEA PEG PEN PET PIE PIG PIN PIT POP POT PUB "
    "PUN PUP PUT RAG RAM RAN RAP RAT RAW RAY RED RIB RID RIG RIM RIP ROB ROD ROT ROW RUB RUG RUM RUN SAD SAP SAT SAW SAY SEA SET SEW SHE SHY SIN SIP SIT "
    "SIX SKI SKY SLY SOB SON SOW SPY SUE SUM SUN TAB TAG TAN TAP TAR TAX TEA TEE TEN THE TIE TIN TIP TOE TON TOO TOP TOW TOY TRY TUB TUG TWO URN USE VAN "
    "VEE WAD WAR WAX WAY WEB WED WEE WET WHO WHY WIG WIN WIT WOE WOK WON WOO WOW YAM YAW YES YET YEW YOU ZEN ZIP ZOO "
).split()
