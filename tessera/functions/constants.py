"""Fixed values that results depend on."""

NAME_TOKENS = {
    "corp": "corporation", "inc": "incorporated", "ltd": "limited", "pvt": "private", "co": "company", "cos": "company",
    "assoc": "associates", "grp": "group", "intl": "international", "svcs": "services", "svc": "service",
    "mfg": "manufacturing", "bros": "brothers", "the": "",
}
NAME_STOPWORDS = [
    "the", "and", "of", "&", "a", "an", "for", "llc", "llp", "inc", "incorporated", "corp", "corporation", "ltd", "limited",
    "pvt", "private", "co", "company", "group", "services", "service", "international", "intl",
]
ADDRESS_TOKENS = {
    "rd": "road", "st": "street", "str": "street", "ave": "avenue", "av": "avenue", "blvd": "boulevard", "dr": "drive",
    "ln": "lane", "ct": "court", "pl": "place", "sq": "square", "apt": "apartment", "bldg": "building", "flr": "floor",
    "hwy": "highway", "pkwy": "parkway", "no": "number", "po": "postoffice", "opp": "opposite",
}
US_STATES = {
    "alabama": "AL", "alaska": "AK", "arizona": "AZ", "arkansas": "AR", "california": "CA", "colorado": "CO", "connecticut": "CT",
    "delaware": "DE", "florida": "FL", "georgia": "GA", "hawaii": "HI", "idaho": "ID", "illinois": "IL", "indiana": "IN", "iowa": "IA",
    "kansas": "KS", "kentucky": "KY", "louisiana": "LA", "maine": "ME", "maryland": "MD", "massachusetts": "MA", "michigan": "MI",
    "minnesota": "MN", "mississippi": "MS", "missouri": "MO", "montana": "MT", "nebraska": "NE", "nevada": "NV", "new hampshire": "NH",
    "new jersey": "NJ", "new mexico": "NM", "new york": "NY", "north carolina": "NC", "north dakota": "ND", "ohio": "OH",
    "oklahoma": "OK", "oregon": "OR", "pennsylvania": "PA", "rhode island": "RI", "south carolina": "SC", "south dakota": "SD",
    "tennessee": "TN", "texas": "TX", "utah": "UT", "vermont": "VT", "virginia": "VA", "washington": "WA", "west virginia": "WV",
    "wisconsin": "WI", "wyoming": "WY",
}
INDIAN_STATES = [
    "andhra pradesh", "arunachal pradesh", "assam", "bihar", "chhattisgarh", "goa", "gujarat", "haryana", "himachal pradesh",
    "jharkhand", "karnataka", "kerala", "madhya pradesh", "maharashtra", "manipur", "meghalaya", "mizoram", "nagaland", "odisha",
    "punjab", "rajasthan", "sikkim", "tamil nadu", "telangana", "tripura", "uttar pradesh", "uttarakhand", "west bengal", "delhi",
    "new delhi", "west delhi", "east delhi", "north delhi", "south delhi", "jammu and kashmir", "ladakh", "puducherry", "chandigarh",
]
#: Phonetic Latin forms of single Devanagari characters.
DEVANAGARI = {
    "अ": "a", "आ": "aa", "इ": "i", "ई": "ii", "उ": "u", "ऊ": "uu", "ऋ": "ri", "ए": "e", "ऐ": "ai", "ओ": "o", "औ": "au",
    "क": "k", "ख": "kh", "ग": "g", "घ": "gh", "ङ": "ng", "च": "ch", "छ": "chh", "ज": "j", "झ": "jh", "ञ": "ny",
    "ट": "t", "ठ": "th", "ड": "d", "ढ": "dh", "ण": "n", "त": "t", "थ": "th", "द": "d", "ध": "dh", "न": "n",
    "प": "p", "फ": "ph", "ब": "b", "भ": "bh", "म": "m", "य": "y", "र": "r", "ल": "l", "व": "v",
    "श": "sh", "ष": "sh", "स": "s", "ह": "h",
    "ा": "a", "ि": "i", "ी": "i", "ु": "u", "ू": "u", "े": "e", "ै": "ai", "ो": "o", "ौ": "au", "ं": "n", "ः": "h", "ँ": "n", "्": "",
    "०": "0", "१": "1", "२": "2", "३": "3", "४": "4", "५": "5", "६": "6", "७": "7", "८": "8", "९": "9",
}
#: Phonetic digits of the letters a to z.
SOUNDEX_DIGITS = "01230120022455012623010202"

MAX_BLOCK_PAIRS = 8000
MAX_BLOCK_SIDE = 2000
CAP_LEXICAL = 40
CAP_VECTOR = 20
TOP_K = 20
MAX_NEGATIVES = 20
SEED = 42
