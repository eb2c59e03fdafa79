"""Declared schemas and vocabularies: no frame in this package is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: category names and the column each one is counted into ---
COMPLAINT_SLOTS = {
    "noise_residential": "Noise - Residential",
    "hot_water": "HEAT/HOT WATER",
    "illegal_parking": "Illegal Parking",
    "blocked_driveway": "Blocked Driveway",
    "street_condition": "Street Condition",
    "heating": "HEATING",
    "plumbing": "PLUMBING",
    "water_system": "Water System",
    "street_light_condition": "Street Light Condition",
    "general_construction": "GENERAL CONSTRUCTION",
}
BOROUGH_SLOTS = {
    "borough_is_Brooklyn": "Brooklyn",
    "borough_is_Staten_Island": "Staten Island",
    "borough_is_Manhattan": "Manhattan",
    "borough_is_Bronx": "Bronx",
    "borough_is_Queens": "Queens",
}
PROPERTY_SLOTS = {
    "property_is_Hotel": "Hotel",
    "property_is_House": "House",
    "property_is_Apartment": "Apartment",
    "property_is_Guest_suite": "Guest suite",
    "property_is_Condominium": "Condominium",
    "property_is_Townhouse": "Townhouse",
    "property_is_Boutique_hotel": "Boutique hotel",
    "property_is_Loft": "Loft",
    "property_is_Serviced_apartment": "Serviced apartment",
}
PROPERTY_OTHER = "property_is_Other"
ROOM_SLOTS = {
    "room_is_private_room": "Private room",
    "room_is_entire_room": "Entire home/apt",
    "room_is_shared_room": "Shared room",
    "room_is_hotel_room": "Hotel room",
}
# Spellings the request form uses for a name the vocabulary already has.
BOROUGH_ALIASES = {"The Bronx": "Bronx"}
# --- end of fixed values ---

COMPLAINT_TOTAL = "all_type_complaint"
SALE_PRICE = "real_estate_price"
LABEL = "price"

COUNT_COLUMNS = [COMPLAINT_TOTAL, *COMPLAINT_SLOTS]

COMPLAINT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("date", T.StringType()),
        T.StructField("agency", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("zip", T.IntegerType()),
        T.StructField("board", T.StringType()),
        T.StructField("borough", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
    ]
)
# Where each clean complaint field sits in a raw line, and the raw line's width.
COMPLAINT_POSITIONS = {
    "id": 0,
    "date": 1,
    "agency": 3,
    "type": 5,
    "zip": 8,
    "board": 23,
    "borough": 25,
    "lat": 38,
    "lon": 39,
}
COMPLAINT_WIDTH = 41

# Where each sale field sits in a raw semicolon row.
SALE_POSITIONS = {"zip": 10, "area": 15, "price": 19, "date": 20}
SALE_WIDTH = 21
SALE_RAW_SCHEMA = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(SALE_WIDTH)])
SALE_MEAN_SCHEMA = T.StructType(
    [
        T.StructField("month", T.StringType()),
        T.StructField("zone", T.StringType()),
        T.StructField(SALE_PRICE, T.DoubleType()),
    ]
)

LISTING_MONEY = ["price", "cleaning_fee", "security_deposit", "extra_people"]
LISTING_FEES = ["cleaning_fee", "security_deposit", "extra_people"]
LISTING_ROOMS = ["bathrooms", "bedrooms", "beds"]
LISTING_REVIEWS = {
    "review_scores_location": 5,
    "review_scores_accuracy": 5,
    "review_scores_rating": 50,
}
LISTING_RAW_SCHEMA = T.StructType(
    [
        T.StructField("zipcode", T.StringType()),
        T.StructField("neighbourhood_group_cleansed", T.StringType()),
        T.StructField("property_type", T.StringType()),
        T.StructField("room_type", T.StringType()),
        T.StructField("accommodates", T.IntegerType()),
        T.StructField("bathrooms", T.DoubleType()),
        T.StructField("bedrooms", T.IntegerType()),
        T.StructField("beds", T.IntegerType()),
        T.StructField("price", T.StringType()),
        T.StructField("cleaning_fee", T.StringType()),
        T.StructField("host_listings_count", T.IntegerType()),
        T.StructField("availability_90", T.IntegerType()),
        T.StructField("extra_people", T.StringType()),
        T.StructField("number_of_reviews", T.IntegerType()),
        T.StructField("security_deposit", T.StringType()),
        T.StructField("minimum_nights", T.IntegerType()),
        T.StructField("review_scores_location", T.DoubleType()),
        T.StructField("review_scores_rating", T.DoubleType()),
        T.StructField("review_scores_accuracy", T.DoubleType()),
    ]
)
LISTING_SCHEMA = T.StructType(
    [
        T.StructField("zipcode", T.StringType()),
        T.StructField("borough", T.StringType()),
        T.StructField("property_type", T.StringType()),
        T.StructField("room_type", T.StringType()),
        T.StructField("accommodates", T.IntegerType()),
        T.StructField("bathrooms", T.DoubleType()),
        T.StructField("bedrooms", T.DoubleType()),
        T.StructField("beds", T.DoubleType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("cleaning_fee", T.DoubleType()),
        T.StructField("host_listings_count", T.IntegerType()),
        T.StructField("availability_90", T.IntegerType()),
        T.StructField("extra_people", T.DoubleType()),
        T.StructField("number_of_reviews", T.IntegerType()),
        T.StructField("security_deposit", T.DoubleType()),
        T.StructField("minimum_nights", T.IntegerType()),
        T.StructField("Date", T.StringType()),
    ]
)
# Numeric listing columns of the training frame, with the label in its place.
LISTING_NUMERIC = {
    "accommodates": "int",
    "bathrooms": "double",
    "bedrooms": "double",
    "beds": "double",
    "price": "double",
    "cleaning_fee": "double",
    "host_listings_count": "int",
    "availability_90": "int",
    "extra_people": "double",
    "security_deposit": "double",
    "minimum_nights": "int",
}
LISTING_FEATURE_COLUMNS = [
    *BOROUGH_SLOTS,
    *PROPERTY_SLOTS,
    PROPERTY_OTHER,
    *ROOM_SLOTS,
    *LISTING_NUMERIC,
]
TRAINING_COLUMNS = [*COUNT_COLUMNS, SALE_PRICE, *LISTING_FEATURE_COLUMNS]
FEATURE_COLUMNS = [c for c in TRAINING_COLUMNS if c != LABEL]

REQUEST_SCHEMA = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "request_id",
            "date",
            "zip",
            "borough",
            "property_type",
            "room_type",
            *(c for c in LISTING_NUMERIC if c != LABEL),
        )
    ]
)
