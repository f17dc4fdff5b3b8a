"""One row per raw table, as text; tests change what they need."""

DAY = "2018-01-02 10:00:00"

DEFAULTS = {
    "orders": {
        "order_id": "o1", "customer_id": "c1", "order_status": "delivered",
        "order_purchase_timestamp": DAY, "order_approved_at": DAY,
        "order_delivered_carrier_date": DAY, "order_delivered_customer_date": DAY,
        "order_estimated_delivery_date": DAY,
    },
    "order_items": {
        "order_id": "o1", "order_item_id": "1", "product_id": "p1", "seller_id": "s1",
        "shipping_limit_date": DAY, "price": "10.0", "freight_value": "2.5",
    },
    "products": {
        "product_id": "p1", "product_category_name": "livros", "product_weight_g": "225.0",
        "product_length_cm": "16", "product_height_cm": "10", "product_width_cm": "14",
    },
    "sellers": {"seller_id": "s1", "seller_city": "campinas", "seller_state": "SP"},
    "customers": {
        "customer_id": "c1", "customer_unique_id": "u1", "customer_city": "franca",
        "customer_state": "SP",
    },
    "payments": {
        "order_id": "o1", "payment_sequential": "1", "payment_type": "voucher",
        "payment_installments": "1", "payment_value": "5.0",
    },
    "reviews": {
        "order_id": "o1", "review_id": "r1", "review_score": "5", "review_comment_title": None,
        "review_comment_message": "bom", "review_creation_date": DAY,
        "review_answer_timestamp": DAY,
    },
    "category_translation": {
        "product_category_name": "livros", "product_category_name_english": "books",
    },
}
