"""Explicit schemas of the nine raw tables (fixed values: column names and order of the source files).

Money is wider than any shop prices it, so that amounts arrive as they were sent.
"""

from __future__ import annotations

RAW_SCHEMAS: dict[str, str] = {
    "orders": """order_id string, customer_id string, order_status string, order_purchase_timestamp string,
        order_approved_at string, order_delivered_carrier_date string, order_delivered_customer_date string,
        order_estimated_delivery_date string""",
    "order_items": """order_id string, order_item_id int, product_id string, seller_id string,
        shipping_limit_date string, price decimal(20,6), freight_value decimal(20,6)""",
    "order_payments": """order_id string, payment_sequential int, payment_type string, payment_installments int,
        payment_value decimal(20,6)""",
    "order_reviews": """review_id string, order_id string, review_score int, review_comment_title string,
        review_comment_message string, review_creation_date string, review_answer_timestamp string""",
    "customers": """customer_id string, customer_unique_id string, customer_zip_code_prefix string,
        customer_city string, customer_state string""",
    "sellers": "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string",
    "products": """product_id string, product_category_name string, product_name_lenght double,
        product_description_lenght double, product_photos_qty double, product_weight_g double,
        product_length_cm double, product_height_cm double, product_width_cm double""",
    "geolocation": """geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double,
        geolocation_city string, geolocation_state string""",
    "product_category_name_translation": "product_category_name string, product_category_name_english string",
}

# Endings of the source file names; whatever stands before them is the publisher's prefix.
FILE_ENDINGS: dict[str, str] = {
    "customers": "customers_dataset.csv",
    "geolocation": "geolocation_dataset.csv",
    "order_items": "order_items_dataset.csv",
    "order_payments": "order_payments_dataset.csv",
    "order_reviews": "order_reviews_dataset.csv",
    "orders": "orders_dataset.csv",
    "products": "products_dataset.csv",
    "sellers": "sellers_dataset.csv",
    "product_category_name_translation": "product_category_name_translation.csv",
}
