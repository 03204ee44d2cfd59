"""Column names and labels shared by all stages.

Fixed values: the output tables are read by existing consumers, so these
spellings are part of the contract.
"""

CUSTOMER_ID = "algonomy_id"
ORDER_ID = "order_id"
TARGET = "ownapp_order_count"

OWNAPP, SWIGGY, INSTORE = "ownapp", "swiggy", "instore"
CHANNELS = (OWNAPP, SWIGGY, INSTORE)

# display label per channel, in the order they appear in a combined label
CHANNEL_LABELS = ((OWNAPP, "OC"), (INSTORE, "Dine in"), (SWIGGY, "Swiggy"))

# daypart -> first and last hour; any other hour is the fallback
DAYPART_HOURS = (
    ("Breakfast", 6, 10),
    ("Lunch", 11, 14),
    ("Evening", 15, 18),
    ("Dinner", 19, 23),
)
DAYPART_FALLBACK = "Late Night"
DAYPARTS = tuple(name for name, _, _ in DAYPART_HOURS) + (DAYPART_FALLBACK,)

PRICE_BINS = (0, 35, 100, 175, 250, 325, 400, 600, 100000)
BUCKET_LABELS = (
    "Add_ons", "Economy", "Value", "Mid_Tier",
    "Premium", "Indulgence", "Ultimate", "Group",
)

EXCLUDE_LABEL = "Exclude"
DRI_LABEL = "Final Dri Category"
BASE_LABEL = "Clubbed base product category"
DRI_PREFIX = "dri_categ_"
BASE_PREFIX = "categ_base_product_"
DRI_LIST = "unique_dri_categories_in_order"
BASE_LIST = "unique_base_products_in_order"

# Fixed values. Base columns of a delivery order: output column -> input column.
DELIVERY_BASE = {
    "order_id": "id",
    "user_id": "user_id",
    "device_type_platform": "platform",
    "order_placed_datetime": "order_placed_datetime",
    "order_channel": "channel",
    "store_name": "store_name",
    "store_mds_id": "store_id_id",
    "actual_delivery_time": "order_delivery_datetime",
    "payment_method": "payment_method",
    "pre_discount_order_value": "gross_price",
    "promo_code_applied": "applied_coupon",
    "discounted_price": "discounted_price",
    "total_price": "total_price",
    "gross_price": "gross_price",
    "actual_subtotal": "actual_subtotal",
    "sub_total_price": "sub_total_price",
    "schedule_datetime": "schedule_datetime",
    "status_id": "status_id",
    "applied_coupon": "applied_coupon",
    "platform": "platform",
    "tip": "tip",
    "order_delivery_datetime": "order_delivery_datetime",
    "before_payment_delivery_eta": "before_payment_delivery_eta",
    "before_payment_pickup_eta": "before_payment_pickup_eta",
    "is_distance_fee_applicable": "is_distance_fee_applicable",
    "offer_applied": "offer_applied",
    "business_model_id_id": "business_model_id_id",
    "algonomy_id": "algonomy_id",
    "store_type": "Store Type",
    "store_generator_new": "Generator New",
    "store_geographical_city": "Geographical City",
    "store_key_city": "Key City",
    "has_query": "has_query",
}

# Fixed values. Base columns of an in-store order: output column -> input column.
INSTORE_BASE = {
    "order_id": "InvoiceNo",
    "order_placed_datetime": "BussTime",
    "BussTime": "BussTime",
    "StoreCode": "StoreCode",
    "total_price": "GrossAmount",
    "discounted_price": "Discount",
    "BaseAmount": "BaseAmount",
    "TransType": "TransType",
    "algonomy_id": "algonomy_id",
    "SaleType": "SaleType",
    "store_type": "Store Type",
    "store_generator_new": "Generator New",
    "store_geographical_city": "Geographical City",
    "store_key_city": "Key City",
}

STORE_COLUMNS = ("Store Name", "Store Type", "Geographical City", "Key City", "Generator New")


def feature_name(column: str, renames: dict[str, str]) -> str:
    """Name of a customer feature in rules and models: scope prefix off, then renamed."""
    bare = column.removeprefix("omnichannel_")
    return renames.get(bare, bare)
