"""Names, spellings and thresholds that decide the results."""

# --- thresholds -------------------------------------------------------------

# Reach of a boundary or of a scraped name, in EPSG:3857 metres.
REACH = 5000.0
# Listings scraped per round.
SCRAPE_BATCH = 40000
# Listings a new region needs before it gets a hull.
HULL_MIN_LISTINGS = 20

# --- supplied columns: supplied name, clean name, type ----------------------

PROPERTY_COLUMNS = [
    ("Property ID", "property_ID", "string"),
    ("Listing Title", "listing_title", "string"),
    ("Property Type", "property_type", "string"),
    ("Listing Type", "listing_type", "string"),
    ("Created Date", "created", "date"),
    ("Last Scraped Date", "scraped", "date"),
    ("Country", "country", "string"),
    ("Latitude", "latitude", "double"),
    ("Longitude", "longitude", "double"),
    ("State", "region", "string"),
    ("City", "city", "string"),
    ("Neighborhood", "neighbourhood", "string"),
    ("Metropolitan Statistical Area", "metro_area", "string"),
    ("Currency Native", "currency", "string"),
    ("Bedrooms", "bedrooms", "double"),
    ("Bathrooms", "bathrooms", "double"),
    ("Max Guests", "max_guests", "double"),
    ("Response Rate", "response_rate", "double"),
    ("Airbnb Superhost", "superhost", "boolean"),
    ("HomeAway Premier Partner", "premier_partner", "boolean"),
    ("Cancellation Policy", "cancellation", "string"),
    ("Security Deposit (USD)", "security_deposit", "double"),
    ("Cleaning Fee (USD)", "cleaning_fee", "double"),
    ("Extra People Fee (USD)", "extra_people_fee", "double"),
    ("Check-in Time", "check_in_time", "string"),
    ("Checkout Time", "check_out_time", "string"),
    ("Minimum Stay", "minimum_stay", "double"),
    ("Number of Reviews", "num_reviews", "double"),
    ("Number of Photos", "num_photos", "double"),
    ("Instantbook Enabled", "instant_book", "boolean"),
    ("Overall Rating", "rating", "double"),
    ("Airbnb Property ID", "ab_property", "string"),
    ("Airbnb Host ID", "ab_host", "string"),
    ("HomeAway Property ID", "ha_property", "string"),
    ("HomeAway Property Manager", "ha_host", "string"),
]

DAILY_COLUMNS = [
    ("Property ID", "property_ID", "string"),
    ("Date", "date", "date"),
    ("Status", "status", "string"),
    ("Booked Date", "booked_date", "date"),
    ("Price (USD)", "price", "double"),
    ("Price (Native)", "price_native", "double"),
    ("Currency Native", "currency", "string"),
    ("Reservation ID", "res_ID", "double"),
    ("Airbnb Property ID", "ab_property", "double"),
    ("HomeAway Property ID", "ha_property", "string"),
]

TRUE_WORDS = ["t", "T", "true", "TRUE", "True", "1"]
FALSE_WORDS = ["f", "F", "false", "FALSE", "False", "0"]

# Clean property table, in column order.
PROPERTY_TABLE = [
    "property_ID", "host_ID", "listing_title", "property_type", "listing_type",
    "created", "scraped", "housing", "latitude", "longitude", "country",
    "region", "city", "neighbourhood", "metro_area", "currency", "bedrooms",
    "bathrooms", "max_guests", "response_rate", "superhost", "premier_partner",
    "cancellation", "security_deposit", "cleaning_fee", "extra_people_fee",
    "check_in_time", "check_out_time", "minimum_stay", "num_reviews",
    "num_photos", "instant_book", "rating", "ab_property", "ab_host",
    "ha_property", "ha_host",
]

# Property types counted as private dwellings (our own default; pass another
# list where the supplier's types differ).
HOUSING_TYPES = [
    "Apartment", "Bungalow", "Cabin", "Chalet", "Condominium", "Cottage",
    "Guest suite", "Guesthouse", "House", "Loft", "Serviced apartment",
    "Townhouse", "Villa",
]

# --- country names ----------------------------------------------------------

COUNTRY_SPELLINGS = {
    "Bosnia and Herzegovina": ["Bosnia-Herzegovina"],
    "Brunei": ["Brunei Darussalam"],
    "Ivory Coast": ["Côte d'Ivoire - Republic of"],
    "Curaçao": ["Curacao"],
    "Falkland Islands (Malvinas)": ["Falkland Islands"],
    "Laos": ["Lao"],
    "Macedonia": ["Macedonia - Republic of"],
    "Palestinian Territories": ["Palestine"],
    "Congo": ["Republic of Congo"],
    "Saint Martin": ["Saint-Martin"],
}

COUNTRY_BY_REGION = {
    "Bhutan": ["Bhutan"],
    "Puerto Rico": ["Puerto Rico"],
    "U.S. Virgin Islands": ["United States Virgin Islands"],
}

# Scraped country -> geocoded countries that overrule it.
COUNTRY_EXCEPTIONS = {
    "France": [
        "French Guiana", "Guadeloupe", "Martinique", "Mayotte", "Réunion",
        "Saint Barthélemy", "Saint Martin", "Suriname",
    ],
    "United Kingdom": ["Guernsey"],
    "United States": ["U.S. Virgin Islands"],
}
BONAIRE_SCRAPED = "Bonaire Sint Eustatius and Saba"
BONAIRE = "Bonaire, Sint Eustatius and Saba"

# --- boundary names ---------------------------------------------------------

# First boundary set.
BOUNDARY_DROPPED = [
    "Akrotiri and Dhekelia", "Antarctica", "Bouvet Island",
    "British Indian Ocean Territory", "Caspian Sea", "Clipperton Island",
    "French Southern Territories", "Heard Island and McDonald Islands", "Iran",
    "North Korea", "Northern Cyprus", "Paracel Islands",
    "South Georgia and the South Sandwich Islands", "Spratly Islands", "Syria",
    "Tokelau", "United States Minor Outlying Islands", "Vatican City",
    "Western Sahara",
]

BOUNDARY_SPELLINGS = {
    "Åland Islands": ["Åland"],
    "Cocos (Keeling) Islands": ["Cocos Islands"],
    "Ivory Coast": ["Côte d'Ivoire"],
    "Falkland Islands (Malvinas)": ["Falkland Islands"],
    "Macau": ["Macao"],
    "Palestinian Territories": ["Palestina"],
    "Réunion": ["Reunion"],
    "Congo": ["Republic of Congo"],
    "Saint Barthélemy": ["Saint-Barthélemy"],
    "Saint Martin": ["Saint-Martin"],
    "East Timor": ["Timor-Leste"],
    "U.S. Virgin Islands": ["Virgin Islands, U.S."],
}

# Second boundary set.
ALT_BOUNDARY_DROPPED = ["Macau"]

ALT_BOUNDARY_SPELLINGS = {
    "Åland Islands": ["Åland"],
    "Antigua and Barbuda": ["Antigua and Barb."],
    "Bosnia and Herzegovina": ["Bosnia and Herz."],
    "British Virgin Islands": ["British Virgin Is."],
    "Cape Verde": ["Cabo Verde"],
    "Cayman Islands": ["Cayman Is."],
    "Central African Republic": ["Central African Rep."],
    "Cook Islands": ["Cook Is."],
    "Czech Republic": ["Czechia"],
    "Democratic Republic of the Congo": ["Dem. Rep. Congo"],
    "Dominican Republic": ["Dominican Rep."],
    "Equatorial Guinea": ["Eq. Guinea"],
    "Swaziland": ["eSwatini"],
    "Falkland Islands (Malvinas)": ["Falkland Is."],
    "Faroe Islands": ["Faeroe Is."],
    "French Polynesia": ["Fr. Polynesia"],
    "Macau": ["Macao"],
    "Marshall Islands": ["Marshall Is."],
    "Northern Mariana Islands": ["N. Mariana Is."],
    "Palestinian Territories": ["Palestine"],
    "Pitcairn Islands": ["Pitcairn Is."],
    "Saint Barthélemy": ["St-Barthélemy"],
    "Saint Kitts and Nevis": ["St. Kitts and Nevis"],
    "Saint Pierre and Miquelon": ["St. Pierre and Miquelon"],
    "Saint Vincent and the Grenadines": ["St. Vin. and Gren."],
    "Saint Martin": ["St-Martin"],
    "São Tomé and Príncipe": ["São Tomé and Principe"],
    "Solomon Islands": ["Solomon Is."],
    "South Sudan": ["S. Sudan"],
    "East Timor": ["Timor-Leste"],
    "Turks and Caicos Islands": ["Turks and Caicos Is."],
    "U.S. Virgin Islands": ["U.S. Virgin Is."],
    "United States": ["United States of America"],
    "Wallis and Futuna": ["Wallis and Futuna Is."],
    "Western Sahara": ["W. Sahara"],
}

# Parts that belong to one country: country -> pattern of the parts' names.
MERGED_COUNTRIES = {
    "Cyprus": "Cyprus|Akrotiri|Dhekelia",
    "Morocco": "^(Morocco|Western Sahara)$",
}

# --- regions ----------------------------------------------------------------

PROVINCES = [
    "Alberta", "British Columbia", "Manitoba", "New Brunswick",
    "Newfoundland and Labrador", "Northwest Territories", "Nova Scotia",
    "Nunavut", "Ontario", "Prince Edward Island", "Québec", "Saskatchewan",
    "Yukon",
]

STATES = [
    "Alabama", "Alaska", "Arizona", "Arkansas", "California", "Colorado",
    "Connecticut", "Delaware", "District of Columbia", "Florida", "Georgia",
    "Hawaii", "Idaho", "Illinois", "Indiana", "Iowa", "Kansas", "Kentucky",
    "Louisiana", "Maine", "Maryland", "Massachusetts", "Michigan", "Minnesota",
    "Mississippi", "Missouri", "Montana", "Nebraska", "Nevada",
    "New Hampshire", "New Jersey", "New Mexico", "New York", "North Carolina",
    "North Dakota", "Ohio", "Oklahoma", "Oregon", "Pennsylvania",
    "Rhode Island", "South Carolina", "South Dakota", "Tennessee", "Texas",
    "Utah", "Vermont", "Virginia", "Washington", "West Virginia", "Wisconsin",
    "Wyoming",
]

PROVINCE_SPELLINGS = {
    "Alberta": [
        "Ab", "AL", "alberta", "ALberta", "Alberta, Canada", "An", "ALBERTA",
        "Calgary", "Edmonton", "Grande Prairie",
    ],
    "British Columbia": [
        "B C", "B.C", "B.C.", "bc", "Bc", "BC Canada", "BC V0N2P0", "BC V1L",
        "BC,", "BC, North Saanich", "BC/Canada", "British Colombia",
        "British Coloumbia", "British Columbia", "British Columbia ",
        "British Columbia (BC)", "British Columbia,", "Burnaby", "Chilliwack",
        "Colombie-Britannique", "Colombie Britannique", "Kamloops", "Kelowna",
        " Invermere", "Invermere", "Squamish BC", "Vancouver", "Surrey",
        "North Vancouver",
    ],
    "Manitoba": ["Manitona", "Mb", "Maniitoba", "manitoba", "Winnipeg", "WInnipeg"],
    "New Brunswick": ["Nouveau-Brunswick", "NEW BRUNSWICK", "New brunswick", "New-Brunswick"],
    "Newfoundland and Labrador": ["Newfoundland", "Newfound Land", "Nl", "Newfoundland "],
    "Nova Scotia": [
        "Cape Breton", "Cape Breton    NS", "Halifax", "Lunenburg, NS",
        "Nouvelle-Écosse", "Nova scotia", "Nova Scotia", "Ns", "NS- 316", "NS,",
    ],
    "Ontario": [
        "Cornwall", "Dundas", "East Gwillimbury", "Eganville", "En Ontario.",
        "Greater Sudbury", "Oakville", "on", "On", "ON",
        "ON / Prince Edward County", " Ontario", "ON,", "ON, Canada", "ont",
        "Ont", "ontario", "Ontario", "ONtario", "ONTARIO", "Ontario,",
        "ONTARIO,", "ONTario", "ontario, canada", "Onterio",
        "Prince Edward County", "Prince Edward County ON", "Toronto",
        "TORONTO", "Ottawa", "Sudbury", "Thunder Bay",
    ],
    "Prince Edward Island": ["PEI"],
    "Québec": [
        "Cantons-de-l'est", "charlevoix Québec", "Gatineau", "Lachine",
        "LaSalle,  Quebec", "Longueuil", "Montreal", "Montreal, Québec",
        "Montréal", "P.Québec", "PQ", "Quebec", " Québec ", "-Quebec", "qc",
        "Qc", "QC ", "QC,", "Qu", "QuÃ©bec", "Que", "quebec", "QUEBEC",
        "Quebéc", "québec", "Québec", "QuÈbec", "Québec ", "Québec City",
        "Quebec, Canada", "Quecbec", "Ville de Québec",
    ],
    "Saskatchewan": ["Sk", "Saskatchwan", "Saskatoon"],
    "Yukon": ["Yukon Territory", "Yukon Territories"],
}

STATE_SPELLINGS = {
    "Alabama": ["Al"],
    "Alaska": ["Ak", "Anchorage"],
    "Arkansas": ["Ar"],
    "Arizona": ["AZ", "Az", "Phoenix"],
    "California": [
        "Ca", "ca", "Anaheim", "Beverly Hills", "California ", "Los Angeles",
        "San Diego",
    ],
    "Colorado": ["Co", "co", "CO", "CO ", "Boulder", "Denver", "Fort Collins"],
    "Florida": [
        "Fl", "fl", " Florida ", "Cape Canaveral", "Cape Coral", "Cocoa Beach",
        "Davenport", "Miami", "Miami Beach", "Panama City Beach",
    ],
    "Georgia": ["Ga", "Atlanta", "Savannah"],
    "Hawaii": ["Hi", "Hi "],
    "Idaho": ["Id"],
    "Illinois": ["Il", "Chicago"],
    "Indiana": ["In"],
    "Kansas": ["Ks"],
    "Kentucky": ["Ky"],
    "Louisiana": ["La", "Baton Rouge", "New Orleans"],
    "Massachusetts": ["Ma", "Allston, Ma", "Boston"],
    "Maryland": ["Md", "Baltimore"],
    "Maine": ["Me", "Bangor"],
    "Michigan": ["Mi"],
    "Minnesota": ["Mn"],
    "Mississippi": ["Ms"],
    "Missouri": ["Mo", "No"],
    "Montana": ["Mt"],
    "Nebraska": ["Ne"],
    "Nevada": ["Nv"],
    "New Hampshire": ["Nh", "NH"],
    "New Mexico": ["Nm"],
    "New Jersey": ["Nj"],
    "New York": [
        "New york", "Ny", "ny", "NY ", "Bronx", "Bronx ", "Brooklyn",
        "Brooklyn ",
    ],
    "Ohio": ["Oh", "Cincinnati", "Cleveland"],
    "Oklahoma": ["Ok", "ok"],
    "Oregon": ["Or"],
    "Pennsylvania": ["Pa"],
    "Rhode Island": ["Ri"],
    "South Carolina": ["Sc", "sc", "Beaufort County"],
    "Tennessee": ["Tn", "tn", "Nashville"],
    "Texas": ["Tx", "Arlington", "Austin", "Dallas", "Houston"],
    "Utah": ["Ut", "ut"],
    "Virginia": ["Va"],
    "Vermont": ["Vt"],
    "Washington": ["Wa"],
    "Wisconsin": ["Wi"],
    "Wyoming": ["Wy", "wy"],
}

REGION_SPELLINGS = {
    "Germany": {"Hamburg (Landmasse)": ["Hamburg"]},
    "Russia": {
        "Far Eastern Federal District": ["Dalnevostochnyj Federalnyj Okrug"],
        "Siberian Federal District": ["Sibirskij Federalnyj Okrug"],
        "Volga Federal District": ["Privolzhskij Federalnyj Okrug"],
        "Northwestern Federal District": ["Severo Zapadnyj Federalnyj Okrug"],
        "Central Federal District": ["Centralnyj Federal Okrug"],
        "North Caucasian Federal District": ["Severo Kavkazskij Federalnyj Okrug"],
        "Ural Federal District": ["Uralskij Federalnyj Okrug"],
        "Southern Federal District": ["Yuzhnyj Federalnyj Okrug"],
    },
}

# Countries whose supplied regions are trusted.
REGION_WHITELIST = [
    "American Samoa", "Australia", "Belize", "Bolivia", "Brazil", "Canada",
    "China", "Curaçao", "Egypt", "El Salvador", "Fiji", "France", "Georgia",
    "Germany", "Ghana", "Guam", "Guatemala", "Honduras", "India", "Indonesia",
    "Italy", "Japan", "Jordan", "Kosovo", "Malaysia", "Martinique", "Mauritius",
    "Mexico", "Nepal", "New Zealand", "Nicaragua", "Northern Mariana Islands",
    "Panama", "Philippines", "Portugal", "Puerto Rico", "Réunion", "Russia",
    "Saint Barthélemy", "Saint Martin", "Senegal", "Sint Maarten",
    "South Africa", "Spain", "Tanzania", "U.S. Virgin Islands", "Ukraine",
    "United Kingdom", "United States", "Venezuela",
]

# Regions that exist in two countries.
SHARED_REGIONS = ["Amazonas", "Distrito Federal", "Granada", "La Paz", "Leon"]

# Countries whose regions come from subdivision boundaries, not from hulls.
SUBDIVIDED_COUNTRIES = ["Canada", "United States"]
