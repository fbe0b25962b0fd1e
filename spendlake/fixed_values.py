"""Values that results depend on.

Everything under a "fixed values" comment is data, stated as published: state
codes, source column headers, label spellings, program names and seed rows.
"""

from __future__ import annotations

# Postal codes and names of the 50 states, DC and Puerto Rico.
STATE_NAMES = {
    "AL": "Alabama",
    "AK": "Alaska",
    "AZ": "Arizona",
    "AR": "Arkansas",
    "CA": "California",
    "CO": "Colorado",
    "CT": "Connecticut",
    "DE": "Delaware",
    "DC": "District of Columbia",
    "FL": "Florida",
    "GA": "Georgia",
    "HI": "Hawaii",
    "ID": "Idaho",
    "IL": "Illinois",
    "IN": "Indiana",
    "IA": "Iowa",
    "KS": "Kansas",
    "KY": "Kentucky",
    "LA": "Louisiana",
    "ME": "Maine",
    "MD": "Maryland",
    "MA": "Massachusetts",
    "MI": "Michigan",
    "MN": "Minnesota",
    "MS": "Mississippi",
    "MO": "Missouri",
    "MT": "Montana",
    "NE": "Nebraska",
    "NV": "Nevada",
    "NH": "New Hampshire",
    "NJ": "New Jersey",
    "NM": "New Mexico",
    "NY": "New York",
    "NC": "North Carolina",
    "ND": "North Dakota",
    "OH": "Ohio",
    "OK": "Oklahoma",
    "OR": "Oregon",
    "PA": "Pennsylvania",
    "PR": "Puerto Rico",
    "RI": "Rhode Island",
    "SC": "South Carolina",
    "SD": "South Dakota",
    "TN": "Tennessee",
    "TX": "Texas",
    "UT": "Utah",
    "VT": "Vermont",
    "VA": "Virginia",
    "WA": "Washington",
    "WV": "West Virginia",
    "WI": "Wisconsin",
    "WY": "Wyoming",
}

# The payment sources are matched against the states and DC only; Puerto Rico
# is a valid state of the fact table but never comes out of a name look-up.
NAME_BY_CODE = {code: name for code, name in STATE_NAMES.items() if code != "PR"}
CODE_BY_NAME = {name: code for code, name in NAME_BY_CODE.items()}

# Titles, subtitles and programs as they are named in the dimensions.
TITLE_COMMODITIES = "Title I: Commodities"
TITLE_CONSERVATION = "Title II: Conservation"
TITLE_NUTRITION = "Title IV: Nutrition"
TITLE_INSURANCE = "Title IX: Crop Insurance"

SUBTITLE_A = "Total Commodities Programs, Subtitle A"
SUBTITLE_D = "Dairy Margin Coverage, Subtitle D"
SUBTITLE_E = "Supplemental Agricultural Disaster Assistance, Subtitle E"

ARC = "Agriculture Risk Coverage (ARC)"
PLC = "Price Loss Coverage (PLC)"
ELAP = "Emergency Assistance for Livestock, Honey Bees, and Farm-Raised Fish Program (ELAP)"
LFP = "Livestock Forage Program (LFP)"
LIP = "Livestock Indemnity Payments (LIP)"
TAP = "Tree Assistance Program (TAP)"
NAP = "Noninsured Crop Disaster Assistance Program (NAP)"
EQIP = "Environmental Quality Incentives Program (EQIP)"
CSP = "Conservation Stewardship Program (CSP)"
CRP = "Conservation Reserve Program (CRP)"
ACEP = "Agricultural Conservation Easement Program (ACEP)"
RCPP = "Regional Conservation Partnership Program (RCPP)"
SNAP = "Supplemental Nutrition Assistance Program (SNAP)"
CROP_INSURANCE = "Crop Insurance"

ARC_CO = "Agriculture Risk Coverage County Option (ARC-CO)"
ARC_IC = "Agriculture Risk Coverage Individual Coverage (ARC-IC)"
TOTAL_CRP = "Total CRP"
GENERAL_SIGN_UP = "General Sign-up"
CONTINUOUS_SIGN_UP = "Continuous Sign-up"
GRASSLAND = "Grassland"
CREP_ONLY = "CREP Only"
CONTINUOUS_NON_CREP = "Continuous Non-CREP"
FARMABLE_WETLAND = "Farmable Wetland"

# Entity names that have a type of their own; other names are "unknown".
ENTITY_TYPES = {
    "subtitle": [SUBTITLE_A, SUBTITLE_D, SUBTITLE_E],
    "program": [PLC, ELAP, LFP, LIP, TAP, EQIP, CSP, SNAP],
    "sub_program": [ARC_CO, ARC_IC, GENERAL_SIGN_UP, CONTINUOUS_SIGN_UP, GRASSLAND],
    "sub_sub_program": [CREP_ONLY, CONTINUOUS_NON_CREP, FARMABLE_WETLAND],
}

# Source headers and the column each one becomes, per title.
COMMODITY_COLUMNS = {
    "payments": "amount",
    "count": "recipient_count",
    "state": "state_name",
    "State Name": "state_name",
    "program": "entity_name",
}
CONSERVATION_COLUMNS = {
    "Pay_year": "year",
    "State": "state_name",
    "state": "state_name",
    "payments": "amount",
    "category_name": "practice_category",
    "StatutoryCategory": "practice_category",
    "practice_code": "practice_code_processed",
    "full_practice_code": "practice_code",
    "Number of Contracts": "contract_count",
    "Number of Acres": "base_acres",
    "Total Financial Assistance Payments ($1000)": "amount",
}
NUTRITION_COLUMNS = {
    "payments": "amount",
    "count": "recipient_count",
    "state": "state_name",
    "State": "state_name",
    "program": "entity_name",
}
INSURANCE_COLUMNS = {
    "state": "state_code",
    "policies_prem": "premium_policy_count",
    "acres_insured": "base_acres",
    "liabilities": "liability_amount",
    "premium": "premium_amount",
    "subsidy": "premium_subsidy_amount",
    "indemnity": "indemnity_amount",
    "farmer_premium": "farmer_premium_amount",
    "loss_ratio": "loss_ratio",
    "net_benefit": "net_farmer_benefit_amount",
}

# Short program labels of the dairy and disaster source.
DAIRY_LABELS = ["Dairy", "DMC", "MPP"]
COMMODITY_LABELS = {
    "Dairy": SUBTITLE_D,
    "DMC": SUBTITLE_D,
    "MPP": SUBTITLE_D,
    "TAP": TAP,
    "NAP": NAP,
    "LFP": LFP,
    "LIP": LIP,
    "ELAP": ELAP,
}

# Spellings found in the conservation sources and the label each one becomes.
CONSERVATION_LABELS = {
    "CRP": CRP,
    "ACEP": ACEP,
    "RCPP": RCPP,
    "EQIP": EQIP,
    "CSP": CSP,
    "Land management": "Land Management",
    "Forest management": "Land Management",
    "Soil remediation": "Soil Remediation",
    "Other 2 - improvement": "Other Improvement",
    "Other 1 - planning": "Other Planning",
    "Conservating planning assessment": "Conservation Planning Assessment",
    "Resource-conserving crop rotatation": "Resource-conserving Crop Rotation",
    "Comprehensive Nutrient Mgt.": "Comprehensive Nutrient Management",
    "Comprehensive Nutrient Mgt. (6(B)(i))": "Comprehensive Nutrient Management",
    "Soil testing": "Soil Testing",
    "Soil remediation (6(A)(vi)": "Soil Remediation",
    "other (6(B)(vi))": "Other Planning",
    "conservating planning assessment (6(B)Iiv))": "Conservation Planning Assessment",
    "Resource-conserving crop rotatation (6(B)(ii)": "Resource-conserving Crop Rotation",
    "Soil health (6(B)(iii))": "Soil Health",
    "Soil testing (6(A)(v))": "Soil Testing",
    "Vegetative (6(A)(iii)": "Vegetative",
    "Structural (6(A)(i))": "Structural",
    "Land Management (6(A)(ii))": "Land Management",
    "Forest management (6(A)(iv))": "Forest Management",
    "Vegetative (6(A)(iii))": "Vegetative",
    "Soil remediation (6(A)(vi))": "Soil Remediation",
    "Other (6(A)(vii))": "Other Improvements",
    "NIPF": "Non-Industrial Private Forestland",
    "Pastured Cropland": "Grassland",
    "2014 Other Practices": "Miscellaneous",
    "Hawaii/Pacific ": "Hawaii",
}

# The sign-up groups of the grouped reserve-program table:
# header prefix, entity name, entity type.
RESERVE_GROUPS = [
    ("Total CRP", TOTAL_CRP, "sub_program"),
    ("Total General Sign-Up", GENERAL_SIGN_UP, "sub_program"),
    ("Total Continuous", CONTINUOUS_SIGN_UP, "sub_program"),
    ("CREP Only", CREP_ONLY, "sub_sub_program"),
    ("Continuous Non-CREP", CONTINUOUS_NON_CREP, "sub_sub_program"),
    ("Farmable Wetland", FARMABLE_WETLAND, "sub_sub_program"),
    ("Grassland", GRASSLAND, "sub_program"),
]
# Header suffix of each measure in a sign-up group.
RESERVE_MEASURES = {
    "ANNUAL RENTAL PAYMENTS ($1000)": "amount",
    "NUMBER OF CONTRACTS": "contract_count",
    "NUMBER OF FARMS": "farm_count",
    "ACRES": "base_acres",
}

# Dimension seeds in id order.
TITLES = [TITLE_COMMODITIES, TITLE_CONSERVATION, TITLE_NUTRITION, TITLE_INSURANCE]
# The texts stored with the titles.
TITLE_DESCRIPTIONS = {
    TITLE_COMMODITIES: (
        "Title I, Commodities cover price and income support for the farmers who raise widely-produced and traded "
        "non-perishable crops, like corn, soybeans, wheat, cotton and rice – as well as dairy and sugar. The title also "
        "includes agricultural disaster assistance. The map shows the total benefits paid to farmers from of the "
        "commodities programs by state from 2018-2022."
    ),
    TITLE_CONSERVATION: (
        "Title II of the law authorizes the Farm Bill’s conservation programs. The programs in this title programs help "
        "agricultural producers and landowners adopt conservation activities on private farm and forest lands. In general, "
        "conservation activities are intended to protect and improve water quality and quantity, soil health, wildlife "
        "habitat, and air quality. The map shows the total benefit of the conservation program by state from 2018-2022."
    ),
    TITLE_NUTRITION: (
        "The Supplemental Nutrition Assistance Program [SNAP] provides financial assistance to low-income families to help "
        "cover the cost of food. Benefits can only be used to purchase food products and are provided in electronic format "
        "similar to a credit card and known as the Electronic Benefit Transfer (EBT) card. The map shows the total SNAP "
        "costs of the nutrition title by state from 2018-2022."
    ),
    TITLE_INSURANCE: (
        "Crop Insurance provides farmers with the option to purchase insurance policies on the acres of crops they plant to "
        "help manage the risks of farming, including to indemnify against losses in yields, crop or whole farm revenue, crop "
        "margins and other risks. The program also offsets the cost of the insurance policies through premium subsidies. In "
        "addition, the program provides Administrative and Operating (A&O) subsidies to the private crop insurance companies "
        "who provide federal crop insurance to farmers. The map shows the total farmer net benefit of the crop insurance "
        "program by state from 2018-2022."
    ),
}
# (subtitle, title)
SUBTITLES = [
    (SUBTITLE_A, TITLE_COMMODITIES),
    (SUBTITLE_D, TITLE_COMMODITIES),
    (SUBTITLE_E, TITLE_COMMODITIES),
]
# (program, title, subtitle or None)
PROGRAMS = [
    (ARC, TITLE_COMMODITIES, SUBTITLE_A),
    (PLC, TITLE_COMMODITIES, SUBTITLE_A),
    (ELAP, TITLE_COMMODITIES, SUBTITLE_E),
    (LFP, TITLE_COMMODITIES, SUBTITLE_E),
    (LIP, TITLE_COMMODITIES, SUBTITLE_E),
    (TAP, TITLE_COMMODITIES, SUBTITLE_E),
    (EQIP, TITLE_CONSERVATION, None),
    (CSP, TITLE_CONSERVATION, None),
    (CRP, TITLE_CONSERVATION, None),
    (ACEP, TITLE_CONSERVATION, None),
    (RCPP, TITLE_CONSERVATION, None),
    (SNAP, TITLE_NUTRITION, None),
    (CROP_INSURANCE, TITLE_INSURANCE, None),
]
# (sub-program, program)
SUB_PROGRAMS = [
    (ARC_CO, ARC),
    (ARC_IC, ARC),
    (TOTAL_CRP, CRP),
    (GENERAL_SIGN_UP, CRP),
    (CONTINUOUS_SIGN_UP, CRP),
    (GRASSLAND, CRP),
]
# (sub-sub-program, sub-program)
SUB_SUB_PROGRAMS = [
    (CREP_ONLY, CONTINUOUS_SIGN_UP),
    (CONTINUOUS_NON_CREP, CONTINUOUS_SIGN_UP),
    (FARMABLE_WETLAND, CONTINUOUS_SIGN_UP),
]
# (name, display name, grouping, program, statutory)
PRACTICE_CATEGORIES = [
    ("Land Management", "Land management", "(6)(A) Practices", EQIP, True),
    ("Forest Management", "Forest management", "(6)(A) Practices", EQIP, True),
    ("Structural", "Structural", "(6)(A) Practices", EQIP, True),
    ("Soil Remediation", "Soil remediation", "(6)(A) Practices", EQIP, True),
    ("Vegetative", "Vegetative", "(6)(A) Practices", EQIP, True),
    ("Other Improvements", "Other improvements", "(6)(A) Practices", EQIP, True),
    ("Soil Testing", "Soil testing", "(6)(A) Practices", EQIP, True),
    ("Conservation Planning Assessment", "Conservation planning assessment", "(6)(B) Practices", EQIP, True),
    ("Other Planning", "Other planning", "(6)(B) Practices", EQIP, True),
    ("Resource-conserving Crop Rotation", "Resource-conserving crop rotation", "(6)(B) Practices", EQIP, True),
    ("Soil Health", "Soil health", "(6)(B) Practices", EQIP, True),
    ("Comprehensive Nutrient Management", "Comprehensive Nutrient Mgt.", "(6)(B) Practices", EQIP, True),
    ("Cropland", "Cropland", "2014 Eligible Land", CSP, False),
    ("Grassland", "Grassland", "2014 Eligible Land", CSP, False),
    ("Rangeland", "Rangeland", "2014 Eligible Land", CSP, False),
    ("Pastureland", "Pastureland", "2014 Eligible Land", CSP, False),
    (
        "Non-Industrial Private Forestland",
        "Non-Industrial Private Forestland (NIPF)",
        "2014 Eligible Land",
        CSP,
        False,
    ),
    ("Land Management", "Land management", "2018 Practices", CSP, False),
    ("Forest Management", "Forest management", "2018 Practices", CSP, False),
    ("Structural", "Structural", "2018 Practices", CSP, False),
    ("Soil Remediation", "Soil remediation", "2018 Practices", CSP, False),
    ("Existing Activity Payments", "Existing activity payments", "2018 Practices", CSP, False),
    ("Vegetative", "Vegetative", "2018 Practices", CSP, False),
    ("Soil Testing", "Soil testing", "2018 Practices", CSP, False),
    ("Other Improvements", "Other improvements", "2018 Practices", CSP, False),
    ("Bundles", "Bundles", "Other CSP", CSP, False),
    ("Miscellaneous", "Miscellaneous", "Other CSP", CSP, False),
    ("(6)(B) Planning", "(6)(B) Planning", "Other CSP", CSP, False),
]
# (code, name, source): practices that no text list holds.
EXTRA_PRACTICES = [
    ("OTP", "Other Payment", "CSP"),
    ("EUP", "Erroneous Underpayment", "CSP"),
    ("ERP", "Equitable Relief Payment", "CSP"),
]

# CSV cell texts that mean "no value".
MISSING_TEXTS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]
