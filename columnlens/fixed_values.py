"""Lists, formats and patterns that decide results.

Everything in this file is a value, not logic.  Each list is the vocabulary a
rule compares with, each pattern the shape a rule accepts; changing one changes
the labels a table gets.  Callers may pass their own in place of any of these.
"""

# --- empty markers -----------------------------------------------------------

EMPTY_PROFILE = ("", "-", "no data", "n/a", "null", "na", "unspecified")
EMPTY_SEMANTIC = ("", "-", "no data", "n/a", "null", "na", "unspecified")
EMPTY_INSIGHT = ("none", "n/a", "na", "-", "no data", "null", "")
EMPTY_TOKENS = {
    "profile": EMPTY_PROFILE,
    "semantic": EMPTY_SEMANTIC,
    "insight": EMPTY_INSIGHT,
}

# How a missing value is written in a profile document.
NULL_TEXT = "None"

# --- cell types --------------------------------------------------------------

INTEGER = "INTEGER (LONG)"
REAL = "REAL"
DATE = "DATE/TIME"
TEXT = "TEXT"

# --- semantic type names -----------------------------------------------------

SEMANTIC_TYPES = (
    "address", "area_of_study", "borough", "building_classification",
    "business_name", "car_make", "city", "city_agency", "college_name", "color",
    "lat_lon_cord", "location_type", "neighborhood", "other", "park_playground",
    "person_name", "phone_number", "school_level", "school_name", "street_name",
    "subject_in_school", "vehicle_type", "website", "zip_code",
)

# --- term lists --------------------------------------------------------------

COLLEGE_TERMS = ("university", "college")

VEHICLE_TERMS = (
    "station wagon/sport utility vehicle", "ambulance", "boat", "trailer",
    "motorcycle", "bus", "taxi", "van", "sedan", "truck", "box truck",
    "passenger vehicle", "sport utility / station wagon", "beverage truck",
    "garbage or refuse", "pick-up truck", "pk", "tractor truck diesel",
    "flat bed", "bike",
)

SCHOOL_LEVEL_TERMS = (
    "k-1", "k-2", "k-3", "k-4", "k-5", "k-6", "k-7", "k-8", "k-9", "k-10",
    "k-11", "k-12", "elementary", "elementary school", "primary",
    "primary school", "high school", "middle", "middle school",
    "high school transfer", "yabc", "senior high school", "college",
)

BUSINESS_TERMS = (
    "market", "pizza", "restaurant", "kitchen", "shop", "cafe", "sushi",
    "panda", "noodle", "bar", "deli", "hotel", "service", "pub",
    "transportation", "svce", "cars", "line",
)

AREA_OF_STUDY_TERMS = (
    "business", "health professions", "law & government", "science & math",
    "architecture", "visual art & design", "engineering", "film/video",
    "hospitality, travel, & tourism", "environmental science",
    "communications", "teaching", "jrotc", "zoned", "animal science",
)

COLOR_TERMS = (
    "gry", "gr", "blk", "orang", "yellow", "blue", "red", "green", "black",
    "brown", "azure", "ivory", "teal", "silver", "purple", "navy blue", "navy",
    "pea green", "gray", "orange", "maroon", "charcoal", "aquamarine", "coral",
    "fuchsia", "wheat", "lime", "crimson", "khaki", "hot pink", "megenta",
    "olden", "plum", "olive", "cyan", "tan", "biege", "bl", "bk", "gy", "wht",
    "wh", "ltg", "white", "rd", "silve", "silvr", "tn", "yw", "dkg", "grn",
    "brn",
)

BOROUGH_TERMS = (
    "k", "m", "q", "r", "x", "new york", "brooklyn", "manhattan", "queens",
    "bronx", "the bronx", "staten island", "clifto", "baldwin", "astoria",
    "mt.kisco", "charlotte", "bklyn", "dobbs ferry", "elmhurst", "maspeth",
    "nyc",
)

CAR_MAKE_TERMS = (
    "peter", "inter", "chevr", "nissa", "workh", "acura", "alfa romeo",
    "aston martin", "audi", "bentley", "bmw", "bugatti", "buick", "cadillac",
    "chevrolet", "datsun", "olds", "chev", "chrysl", "mercur", "chrysler",
    "citroen", "dodge", "ferrari", "fiat", "ford", "geely", "general motors",
    "gmc", "honda", "hyundai", "infiniti", "jaguar", "jeep", "kia",
    "koenigsegg", "lamborghini", "land rover", "lexus", "masrati", "mazda",
    "mclaren", "mercedes benz", "mercedes-benz", "mini", "mitsubishi",
    "nissan", "pagani", "peugeot", "porsche", "ram", "renault", "rolls royce",
    "saab", "subaru", "suzuki", "tata motors", "tesla", "chevy", "toyota",
    "volkswagen", "volvo", "cadi", "unk", "pont", "hobbs", "pontia", "linc",
    "plym", "lincol", "v.w", "vw", "gm", "volks",
)

SUBJECT_TERMS = ("english", "math", "science", "social studies")

# The insight report counts these five only.
BOROUGH_NAMES = ("brooklyn", "bronx", "queens", "manhattan", "staten island")

# Two terms of the car-make list read as one in the uncorrected rule set.
CAR_MAKE_FUSED = {"mercur", "chrysler"}
CAR_MAKE_FUSED_AS = "mercurchrysler"

# --- patterns ----------------------------------------------------------------
# All are tried at the start of the lower-cased value; a closing $ asks for the
# whole value.

ZIP_CODE = r"[0-9]{5}(?:-[0-9]{4})?$"
BUILDING = r"[a-z][0-9]{1,2}-(walk-up|elevator|condops)"
# One run of host characters with no two separators in a row: the same hosts as
# a repeated "separator, word" group, without a group loop over a long value.
WEBSITE = (
    r"(https?://(www\.)?)?(?![^/:]*[-.]{2})[a-z0-9][a-z0-9.-]*"
    r"\.[a-z]{2,5}(:[0-9]{1,5})?(/.*)?$"
)
COORDINATE_PAIR = (
    r"[-+]?([1-8]?\d(\.\d+)?|90(\.0+)?),\s*"
    r"[-+]?(180(\.0+)?|((1[0-7]\d)|([1-9]?\d))(\.\d+)?)$"
)
COORDINATE = r"(([1-9]\d?|1[0-7]\d)\.\d{3,7}|180|0(\.\d{1,6})?)$"
COORDINATE_LOOSE = r"(([1-9]\d?)|(1[0-7]\d))(\.\d{3,7})|180|0(\.\d{1,6})?"
PHONES = (
    r"[2-9]\d{2}-\d{3}-\d{4}$",
    r"((\(\d{3}\) ?)|(\d{3}-))?\d{3}-\d{4}",
    r"(1?(-?\d{3})-?)?(\d{3})(-?\d{4})$",
)
# The last word has up to 50 characters, as one repeat: five repeats of up to ten, one in the
# other, accept the same and are tried in as many ways as there are sums.
SCHOOL = (
    r"([a-z0-9]{1,10} ){1,5}(high school|middle school|studies|charter school|"
    r"elementary school|(school|academy) (of|for) [a-z0-9]{1,50})$"
)
PARK = r"([a-z0-9]{1,10} ){1,5}(park|playground)$"
STREET_ENDINGS = (
    r"(place|avenue|ave|ave\.|court|ct|street|st|drive|dr|lane|ln|road|rd|"
    r"blvd|plaza|parkway|pkwy)$"
)
STREET = r"([a-z0-9]{1,10} ){1,2}" + STREET_ENDINGS
STREET_INSIGHT = r"([a-zA-Z0-9]{1,10} ){1,5}" + STREET_ENDINGS
# A prefix: what may follow and may be empty is left out. The optional first word has its blank
# with it, so that a long word is not split in two at each of its characters.
ADDRESS = r"\d+[a-z]*\s(\w*\s)?\w+\s\w{2}"
LEADING_NUMBER = r"[0-9]"

# --- cell shapes -------------------------------------------------------------

INTEGER_SHAPE = r"^\s*[-+]?[0-9]+\s*$"
REAL_SHAPE = r"^\s*[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?\s*$"
NOT_A_NUMBER_SHAPE = r"^\s*[-+]?[nN][aA][nN]\s*$"
INFINITY_SHAPE = r"^\s*[-+]?[iI][nN][fF]([iI][nN][iI][tT][yY])?\s*$"
# what numbers and dates may begin and end with, blanks that are no spaces included
FIRST_CHARACTERS = (*"0123456789+-.nNiI", "\t", "\n", "\x0b", "\f", "\r")
LAST_CHARACTERS = (*"0123456789.nNfFyY", "\t", "\n", "\x0b", "\f", "\r")
# shape of the text, then how to write it year first
DATE_SHAPES = (
    (r"^([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})\z", "$1-$2-$3"),
    (r"^([0-9]{1,2})-([0-9]{1,2})-([0-9]{4})\z", "$3-$2-$1"),
    (r"^([0-9]{4})/([0-9]{1,2})/([0-9]{1,2})\z", "$1-$2-$3"),
    (r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})\z", "$3-$1-$2"),
)

# --- sizes -------------------------------------------------------------------

TOP_VALUES = 5
TOP_TALLY = 100
TOP_STREETS = 10
SIMILARITY = 0.8
