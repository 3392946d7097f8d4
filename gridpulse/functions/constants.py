"""Fixed values of the sensor domain."""

# --- fixed values: areas and their zone -------------------------------------
AREA_ZONE = {
    "Whitefield": "East", "Electronic City": "South", "MG Road": "Central", "Indiranagar": "East",
    "Yelahanka": "North", "Silk Board": "South", "Hebbal": "North", "Marathahalli": "East",
    "BTM Layout": "South", "Jayanagar": "South", "Rajajinagar": "West", "Banashankari": "South",
    "Koramangala": "South", "HSR Layout": "South", "Bellandur": "East", "KR Puram": "East",
    "Malleshwaram": "West", "Basavanagudi": "South", "Ulsoor": "Central", "Domlur": "East",
    "Kengeri": "West", "Magadi Road": "West", "Peenya": "West", "Nagawara": "North",
    "Thanisandra": "North", "Hennur": "North", "Varthur": "East", "Sarjapur": "East",
    "Devanahalli": "North", "Chandapura": "South", "Attibele": "South", "Bommanahalli": "South",
    "Kadugodi": "East", "Bidadi": "West", "Rajarajeshwari Nagar": "West", "Yeshwanthpur": "West",
    "Shivajinagar": "Central", "Majestic": "Central", "Cubbon Park": "Central",
    "JP Nagar": "South", "Bannerghatta Road": "South",
}

# --- fixed values: road types (an area in neither list is on a Main Road) ----
HIGHWAY_AREAS = [
    "Whitefield", "Electronic City", "Hebbal", "Devanahalli", "Bidadi", "Attibele",
    "Sarjapur", "Chandapura", "Kengeri", "Varthur",
]
STREET_AREAS = [
    "MG Road", "Indiranagar", "Basavanagudi", "Ulsoor", "Domlur", "Magadi Road", "Shivajinagar",
    "Majestic", "Cubbon Park", "Rajarajeshwari Nagar", "Bannerghatta Road",
]

# --- fixed values: area roles -------------------------------------------------
IT_HUB_AREAS = [
    "Whitefield", "Electronic City", "Marathahalli", "Bellandur",
    "HSR Layout", "Koramangala", "Sarjapur", "JP Nagar",
]
LEISURE_AREAS = [
    "MG Road", "Indiranagar", "Koramangala", "Jayanagar", "Malleshwaram", "Basavanagudi",
    "Majestic", "Cubbon Park", "BTM Layout", "JP Nagar", "HSR Layout",
]
INDUSTRIAL_AREAS = ["Peenya", "Yeshwanthpur", "Bommanahalli", "Attibele", "Bidadi"]

# --- fixed values: area weights (1.0 where not listed) -----------------------
TRAFFIC_WEIGHT = {
    "Whitefield": 1.8, "Electronic City": 1.8, "Marathahalli": 1.8, "Bellandur": 1.7,
    "HSR Layout": 1.5, "Koramangala": 1.5, "Sarjapur": 1.4, "JP Nagar": 1.4, "Silk Board": 1.9,
    "BTM Layout": 1.3, "MG Road": 1.3, "Yeshwanthpur": 1.4, "Peenya": 1.4, "Malleshwaram": 1.2,
    "Majestic": 1.3,
}
ENERGY_WEIGHT = {
    "Whitefield": 1.9, "Electronic City": 1.9, "Marathahalli": 1.7, "Bellandur": 1.6,
    "HSR Layout": 1.6, "Koramangala": 1.6, "Sarjapur": 1.5, "JP Nagar": 1.6, "Peenya": 2.0,
    "Yeshwanthpur": 1.8, "Majestic": 1.4, "MG Road": 1.3, "Bommanahalli": 1.7, "Attibele": 1.6,
}
POLLUTION_WEIGHT = {
    "Whitefield": 1.4, "Electronic City": 1.5, "Marathahalli": 1.4, "Bellandur": 1.4,
    "HSR Layout": 1.3, "Koramangala": 1.3, "Sarjapur": 1.3, "JP Nagar": 1.3, "Silk Board": 1.9,
    "Peenya": 2.0, "Yeshwanthpur": 1.8, "KR Puram": 1.5, "Bommanahalli": 1.6, "Majestic": 1.5,
}

# --- fixed values: calendar, scheduled events, neighbours --------------------
HOLIDAYS = [(10, 24, 1.5), (1, 26, 1.3), (8, 15, 1.2), (12, 31, 1.4)]
SCHEDULED_EVENTS = [
    ("MG Road", "2026-03-10", "2026-03-12", 1.6),
    ("Koramangala", "2026-04-05", "2026-04-06", 1.5),
    ("Whitefield", "2026-06-20", "2026-06-22", 1.4),
    ("MG Road", "2024-12-20", "2024-12-26", 1.6),
    ("Koramangala", "2024-11-10", "2024-11-12", 1.5),
]
NEIGHBOURS = {
    "Silk Board": ["Marathahalli", "Bellandur", "Koramangala"],
    "Marathahalli": ["Silk Board", "Koramangala", "Whitefield"],
    "Whitefield": ["KR Puram", "Varthur", "Marathahalli"],
    "Electronic City": ["Bommanahalli", "Attibele", "Koramangala"],
    "Koramangala": ["HSR Layout", "Jayanagar", "Marathahalli"],
    "Majestic": ["Cubbon Park", "MG Road", "Malleshwaram"],
    "Peenya": ["Yeshwanthpur", "Magadi Road", "KR Puram"],
}

# --- fixed values: roads -------------------------------------------------------
ROAD_CAPACITY = {"Highway": 1200.0, "Main Road": 750.0, "Street": 350.0}
FREE_FLOW_SPEED = {"Highway": 80.0, "Main Road": 55.0, "Street": 35.0}

# --- fixed values: text that stands for a missing value (trimmed, lower case) -
NULL_TOKENS = ["", "null", "none", "nan", "na", "n/a"]

# --- fixed values: defaults for fields whose absence has a meaning -----------
NAMED_DEFAULTS = {"incident": "No Incident", "severity": "No Severity", "event": "No Event"}

# --- fixed values: display orders ----------------------------------------------
SEVERITY_ORDER = ["HIGH", "MEDIUM", "LOW"]
AQI_BANDS = ["Good", "Moderate", "Unhealthy (Sensitive)", "Unhealthy", "Hazardous"]
WEEKDAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
