"""Declared schemas of the raw tables. Nothing is inferred; all timestamps carry no zone."""

from __future__ import annotations

RAW_SCHEMAS = {
    "orders": """order_id string, customer_id string, order_status string,
        order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz,
        order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz,
        order_estimated_delivery_date timestamp_ntz""",
    "order_items": """order_id string, order_item_id int, product_id string, seller_id string,
        shipping_limit_date timestamp_ntz, price double, freight_value double""",
    "order_payments": """order_id string, payment_sequential int, payment_type string,
        payment_installments int, payment_value double""",
    "order_reviews": """review_id string, order_id string, review_score int,
        review_comment_title string, review_comment_message string,
        review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz""",
    "customers": """customer_id string, customer_unique_id string, customer_zip_code_prefix int,
        customer_city string, customer_state string""",
    "sellers": """seller_id string, seller_zip_code_prefix int, seller_city string,
        seller_state string""",
    "products": """product_id string, product_category_name string, product_weight_g double,
        product_length_cm double, product_height_cm double, product_width_cm double,
        product_photos_qty double""",
    "geolocation": """geolocation_zip_code_prefix int, geolocation_lat double,
        geolocation_lng double, geolocation_city string, geolocation_state string""",
    "product_category_name_translation": """product_category_name string,
        product_category_name_english string""",
    "seed_state_region": "state_code string, state_name string, region string",
}
