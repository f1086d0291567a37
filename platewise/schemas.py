"""Output table schemas, declared once; ``conform`` selects and casts to them."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, DT = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.DateType()


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


DISH_TAGGING = _schema(("menu_id", L), ("menu_name", S), ("category_id", I), ("prob", D),
                       ("dish_type_l3", S), ("new_dish_type_l3", S), ("new_category_id", I),
                       ("run_date", DT))
AREA_CATEGORY = _schema(("subdistrict", S), ("dish_type_l3", S), ("category_id", I),
                        ("total_amount", D), ("total_orders", L), ("run_date", DT),
                        ("num_retro_days", I), ("busi_dt", DT))
CUSTOMER_CATEGORY = _schema(("user_id", S), ("count_order", L), ("recent_order_dt", DT),
                            ("dish_type_l3", S), ("category_id", I), ("decile", I), ("rank", I),
                            ("percentile", S), ("busi_dt", DT))
MENU_CATEGORY = _schema(("user_id", S), ("count_order", L), ("dish_type_l3", S), ("category_id", I),
                        ("decile", I), ("percentile", S), ("busi_dt", DT))
SHOP_CATEGORY = _schema(("shop_id", L), ("shop_name", S), ("shop_category", S), ("category_id", I),
                        ("order_count", L), ("busi_dt", DT))
CUSTOMER_CATEGORY_LIST = _schema(("user_id", S), ("sv_dish_types", T.ArrayType(S)),
                                 ("sv_dish_count", L), ("gd_dish_types", S), ("busi_dt", DT))
