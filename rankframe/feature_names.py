"""Default column names of the interaction table."""

from __future__ import annotations

# The column names of the source table, in the order the packed
# numeric vector uses.  They have to be spelt exactly like this for the data to match.
NUMERIC_FEATURES: tuple[str, ...] = tuple(
    """
    broker_aov_usd_l7d
    broker_first_time_purchase_aov_usd_l7d
    broker_first_time_purchase_aov_usd_l90d
    broker_first_time_purchase_order_count_sum_l90d
    broker_first_time_purchase_total_sales_usd_sum_l30d
    broker_first_time_purchase_total_sales_usd_sum_l90d
    broker_native_order_aov_usd_l1d
    broker_native_order_aov_usd_l30d
    broker_native_order_aov_usd_l7d
    broker_native_order_aov_usd_l90d
    broker_native_order_count_sum_l30d
    broker_native_order_count_sum_l7d
    broker_native_order_count_sum_l90d
    broker_native_order_days_count_l30d
    broker_native_order_male_product_total_sales_sum_l90d
    broker_native_order_total_sales_usd_sum_l90d
    broker_order_count_sum_l30d
    broker_order_count_sum_l90d
    broker_order_days_count_l90d
    broker_pay_order_aov_usd_l30d
    broker_pay_order_aov_usd_l7d
    broker_pay_order_count_sum_l90d
    broker_pay_order_days_count_l90d
    broker_pay_order_total_sales_usd_sum_l30d
    broker_pay_order_total_sales_usd_sum_l90d
    broker_repeat_purchase_order_count_sum_l90d
    broker_repeat_purchase_total_sales_usd_sum_l30d
    broker_repeat_purchase_total_sales_usd_sum_l90d
    broker_shop_campaign_offer_order_count_sum_l7d
    broker_total_sales_usd_sum_l90d
    product_all_order_types_avg_price_local_avg_l30d
    product_all_order_types_avg_price_local_avg_l7d
    product_all_order_types_avg_price_usd_avg_l1d
    product_all_order_types_avg_price_usd_avg_l30d
    product_all_order_types_avg_price_usd_avg_l7d
    product_all_order_types_order_count_sum_l1d
    product_all_order_types_order_count_sum_l7d
    product_all_order_types_total_price_local_sum_l7d
    product_all_order_types_total_quantity_sum_l1d
    product_all_order_types_total_quantity_sum_l30d
    product_all_order_types_total_quantity_sum_l7d
    product_ctr_l1d
    product_ctr_l30d
    product_ctr_l7d
    product_home_feed_algo_best_sellers_ctr_l30d
    product_home_feed_algo_best_sellers_impression_count_l7d
    product_home_feed_algo_high_intent_impression_count_l1d
    product_home_feed_algo_high_intent_impression_count_l30d
    product_home_feed_algo_new_arrivals_ctr_l30d
    product_home_feed_algo_popular_impression_count_l1d
    product_home_feed_algo_popular_impression_count_l30d
    product_impression_count_l30d
    product_native_order_avg_price_local_avg_l1d
    product_native_order_avg_price_local_avg_l30d
    product_native_order_avg_price_local_avg_l7d
    product_native_order_avg_price_usd_avg_l1d
    product_native_order_avg_price_usd_avg_l30d
    product_native_order_avg_price_usd_avg_l7d
    product_native_order_order_count_sum_l1d
    product_native_order_order_count_sum_l30d
    product_native_order_order_count_sum_l7d
    product_native_order_total_price_local_sum_l30d
    product_native_order_total_price_usd_sum_l7d
    product_native_order_total_quantity_sum_l1d
    product_native_order_total_quantity_sum_l30d
    product_native_order_total_quantity_sum_l7d
    product_page_type_boosted_merchants_click_count_l7d
    product_page_type_home_feed_click_count_l30d
    product_page_type_home_feed_ctr_l1d
    product_page_type_home_feed_ctr_l30d
    product_page_type_home_feed_ctr_l7d
    product_page_type_home_feed_impression_count_l30d
    product_page_type_home_feed_impression_count_l7d
    product_page_type_shop_store_click_count_l30d
    product_page_type_shop_store_click_count_l7d
    product_page_type_shop_store_ctr_l30d
    product_page_type_shop_store_ctr_l7d
    product_page_type_shop_store_impression_count_l30d
    product_rating_average_l30d
    product_review_count_l30d
    product_shop_campaign_offer_order_avg_price_local_avg_l1d
    product_shop_campaign_offer_order_avg_price_local_avg_l30d
    product_shop_campaign_offer_order_total_price_local_sum_l30d
    product_shop_campaign_offer_order_total_quantity_sum_l1d
    product_shop_campaign_order_avg_price_local_avg_l1d
    product_shop_campaign_order_avg_price_usd_avg_l1d
    product_shop_campaign_order_order_count_sum_l1d
    product_shop_campaign_order_total_price_local_sum_l30d
    product_shop_campaign_order_total_price_local_sum_l7d
    product_shop_cash_redemption_order_avg_price_local_avg_l1d
    product_shop_cash_redemption_order_avg_price_local_avg_l30d
    product_shop_cash_redemption_order_avg_price_local_avg_l7d
    product_shop_cash_redemption_order_avg_price_usd_avg_l1d
    product_shop_cash_redemption_order_avg_price_usd_avg_l30d
    product_shop_cash_redemption_order_avg_price_usd_avg_l7d
    product_shop_cash_redemption_order_order_count_sum_l1d
    product_shop_cash_redemption_order_order_count_sum_l30d
    product_shop_cash_redemption_order_total_price_usd_sum_l30d
    product_shop_cash_redemption_order_total_quantity_sum_l1d
    product_shop_cash_redemption_order_total_quantity_sum_l30d
    product_shop_pay_order_avg_price_local_avg_l1d
    product_shop_pay_order_avg_price_local_avg_l30d
    product_shop_pay_order_avg_price_local_avg_l7d
    product_shop_pay_order_avg_price_usd_avg_l1d
    product_shop_pay_order_avg_price_usd_avg_l30d
    product_shop_pay_order_avg_price_usd_avg_l7d
    product_shop_pay_order_order_count_sum_l1d
    product_shop_pay_order_order_count_sum_l30d
    product_shop_pay_order_order_count_sum_l7d
    product_shop_pay_order_total_quantity_sum_l1d
    product_shop_pay_order_total_quantity_sum_l7d
    product_shop_server_order_avg_price_local_avg_l30d
    product_shop_server_order_avg_price_local_avg_l7d
    product_shop_server_order_avg_price_usd_avg_l1d
    product_shop_server_order_avg_price_usd_avg_l30d
    product_shop_server_order_avg_price_usd_avg_l7d
    product_shop_server_order_order_count_sum_l1d
    product_shop_server_order_order_count_sum_l7d
    product_shop_server_order_total_quantity_sum_l1d
    product_shop_server_order_total_quantity_sum_l7d
    store_num_active_products_l14d
    store_num_active_products_l7d
    user_aov_l180d
    user_aov_l30d
    user_aov_l365d
    user_avg_per_item_spent_l180d
    user_avg_per_item_spent_l30d
    user_avg_per_item_spent_l365d
    user_broker_cumulative_total_order_count
    user_broker_days_with_click_count_sum_l1d
    user_broker_days_with_click_count_sum_l30d
    user_broker_days_with_click_count_sum_l7d
    user_broker_days_with_impression_count_sum_l7d
    user_broker_days_with_order_count_sum_l30d
    user_broker_days_with_order_count_sum_l7d
    user_broker_days_with_shop_store_view_count_sum_l30d
    user_broker_following_rail_impression_count_sum_l30d
    user_broker_following_rail_impression_count_sum_l7d
    user_broker_high_intent_recommendation_impression_count_sum_l30d
    user_broker_high_intent_recommendation_impression_count_sum_l7d
    user_broker_merchant_impression_count_sum_l1d
    user_broker_merchant_impression_count_sum_l7d
    user_broker_merchant_non_home_feed_impression_count_sum_l30d
    user_broker_merchant_non_home_feed_impression_count_sum_l7d
    user_broker_native_shop_store_view_count_sum_l1d
    user_broker_native_shop_store_view_count_sum_l30d
    user_broker_native_shop_store_view_count_sum_l7d
    user_broker_order_count_sum_l1d
    user_broker_order_count_sum_l30d
    user_broker_order_count_sum_l7d
    user_broker_product_click_count_sum_l30d
    user_broker_product_click_count_sum_l7d
    user_broker_product_impression_count_sum_l1d
    user_broker_product_impression_count_sum_l30d
    user_broker_product_impression_count_sum_l7d
    user_broker_ranked_merchant_recommendation_impression_count_sum_l30d
    user_broker_ranked_merchant_recommendation_impression_count_sum_l7d
    user_broker_recently_viewed_impression_count_sum_l30d
    user_broker_recently_viewed_impression_count_sum_l7d
    user_broker_total_click_count_sum_l1d
    user_broker_total_click_count_sum_l30d
    user_broker_total_impression_count_sum_l1d
    user_broker_total_impression_count_sum_l30d
    user_broker_total_impression_count_sum_l7d
    user_follows_broker
    user_native_order_count_sum_l30d
    user_native_order_count_sum_l365d
    user_native_order_count_sum_l7d
    user_native_order_count_sum_l90d
    user_pay_order_count_sum_l30d
    user_pay_order_count_sum_l365d
    user_pay_order_count_sum_l7d
    user_pay_order_count_sum_l90d
    user_product_buy_action_l30d
    user_product_buy_action_l7d
    user_product_buy_action_l90d
    user_product_favorite_count_l30d
    user_product_favorited_l90d
    user_product_pdp_views_l30d
    user_product_pdp_views_l7d
    user_product_pdp_views_l90d
    user_product_purchased_l30d
    user_product_purchased_l7d
    user_product_purchased_l90d
    user_shop_cash_balance_usd
    """.split()
)

# The categorical columns of the source table.
CATEGORICAL_FEATURES: tuple[str, ...] = (
    "level_0_product_category",
    "level_1_product_category",
    "level_2_product_category",
    "level_3_product_category",
    "level_4_product_category",
    "page_type",
)

# Fixed value: length of the text-embedding vectors.
EMBEDDING_DIM = 768
