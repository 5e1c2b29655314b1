"""Rows of the visit table for tests."""


def visit(date="2019-01-01", user_id=1, session_id="s1", click_category_id=-1, click_product_id=-1,
          order=None, pay=None, city_id=1):
    return (date, user_id, session_id, 1, f"{date} 00:00:00", None, click_category_id,
            click_product_id, order, None, pay, None, city_id)
