"""File-to-file jobs on small literal files in the shapes of FIXTURES.md §B."""

import os
from decimal import Decimal

from tidewater.plans import jobs


def _write(path, text, encoding="utf-8"):
    with open(path, "w", encoding=encoding) as f:
        f.write(text)


def test_commerce_etl_end_to_end(spark, tmp_dir):
    o = os.path.join(tmp_dir, "orders.csv")
    c = os.path.join(tmp_dir, "customers.csv")
    p = os.path.join(tmp_dir, "products.csv")
    _write(o, "order_id,customer_id,product_id,order_date,ship_date,quantity,unit_price,discount_pct,total_amount,"
              "payment_method,order_status\n"
              "1,10,P1,2024-01-05,2024-01-07,2,$10.00,10,$18.00,Visa,Delivered\n"
              "1,10,P1,2024-01-05,2024-01-07,2,$10.00,10,$18.00,Visa,Delivered\n"
              "2,11,P2,01-06-2024,2024-01-01,1,5.50,0,5.50,Debit,Unknown\n"
              "3,12,X9,2024/01/07,,1,1.00,0,1.00,Cash,Pending\n"
              "4,10,P2,2024-02-30,,1,1.00,0,1.00,Visa,Pending\n"
              "5,10,P2,2024-02-01,,0,1.00,0,1.00,Visa,Pending\n"
              "6,11,P1,2024-02-03,N/A,1,abc,0,1.00,Visa,Pending\n"
              "7,11,P1,2024-02-03,NULL,3,4.00,150,\"1,299.99\",MasterCard,Shipped\n"
              "8,11,P1,2024-02-04,,3,4.00,,12.00,MasterCard,Shipped\n")
    _write(c, "customer_id,first_name,last_name,email,phone,signup_date,country,state,postal_code,is_active,"
              "loyalty_points\n"
              "10, Ann ,Lee,ANN@EXAMPLE.COM,(555) 123-4567,2023-01-01,U.S.A.,minnesota,55101,yes,-5\n"
              "11,Bo,Ng,bo@example.com,555-1234,01-02-2023,canada,ON,00000,N,\n"
              "12,Cy,,cy@bad,5551234567,2023/01/03,USA,CA,90001,maybe,7\n")
    _write(p, "product_id,product_name,category,brand,price,cost,stock_quantity,weight_kg,created_date,is_active\n"
              "P1,Lamp,Home,acme,$10.00,4.00,-3,1.5,2022-01-01,Yes\n"
              "P2,Pen,Office,bic,\"399,99\",1.00,5,0.1,2022/02/02, y \n"
              "P3,Cup,Home,zed,\"1,299.99\",1.00,5,0.1,2022-03-03,no\n")
    out = jobs.commerce_etl(spark, o, c, p, os.path.join(tmp_dir, "out"))
    orders = {r.order_id: r for r in out["orders"].collect()}
    assert set(orders) == {1, 2}  # dedup, bad id/date/qty/price/discount/total rows removed
    assert str(orders[1].total_amount) == "18.00" and orders[1].payment_method == "Credit Card"
    assert orders[2].ship_date is None and orders[2].order_status is None  # ship before order; unknown status
    cust = {r.customer_id: r for r in out["customers"].collect()}
    assert set(cust) == {10, 11}
    assert (cust[10].first_name, cust[10].email, cust[10].phone, cust[10].state, cust[10].country,
            cust[10].is_active, cust[10].loyalty_points) == ("Ann", "ann@example.com", "5551234567", "MN", "USA", True, 0)
    assert cust[11].phone is None and cust[11].country == "Canada"
    prods = {r.product_id: r for r in out["products"].collect()}
    assert set(prods) == {"P1", "P2"} and prods["P2"].price == Decimal("399.99") and prods["P1"].stock_quantity == 0
    assert prods["P1"].brand == "Acme"
    rev = {r.category: (str(r.total_revenue), r.total_orders) for r in out["revenue_by_category"].collect()}
    assert rev == {"Home": ("18.00", 1), "Office": ("5.50", 1)}


def _triple(folder, orders):
    o, c, p = (os.path.join(folder, f"{n}.csv") for n in ("orders", "customers", "products"))
    _write(o, "order_id,customer_id,product_id,order_date,ship_date,quantity,unit_price,discount_pct,total_amount,payment_method,order_status\n" + orders)
    _write(c, "customer_id,first_name,last_name,email,phone,signup_date,country,state,postal_code,is_active,loyalty_points\n"
              "10,Ann,Lee,ann@example.com,,2023-01-01,USA,MN,55101,yes,1\n11,Bo,Ng,bo@example.com,,2023-01-02,USA,MN,1,no,2\n")
    _write(p, "product_id,product_name,category,brand,price,cost,stock_quantity,weight_kg,created_date,is_active\n"
              "P1,Lamp,Home,acme,$10.125,4.0625,3,1.125,2022-01-01,Yes\n")
    return o, c, p


def test_decimals_are_rounded_once_at_the_end(spark, tmp_dir):
    paths = _triple(tmp_dir, "1,10,P1,2024-01-05,,2,100.00,12.345,1,Cash,Pending\n2,11,P1,2024-01-05,,2,5.555,0,1,Cash,Pending\n"
                             "3,10,P1,2024-01-05,,1,0.0049,0,1,Cash,Pending\n4,10,P1,2024-01-05,,1,10,100000000,1,Cash,Pending\n")
    out = jobs.commerce_etl(spark, *paths, os.path.join(tmp_dir, "out"))
    orders = {r.order_id: r for r in out["orders"].collect()}
    assert [orders[k].total_amount for k in (1, 2, 3, 4)] == [Decimal("175.31"), Decimal("11.11"), Decimal("0.00"), Decimal("10.00")]
    assert orders[3].unit_price == Decimal("0.0049") and orders[1].discount_pct == Decimal("12.345")
    (product,) = out["products"].collect()
    assert (product.price, product.cost, product.weight_kg) == (Decimal("10.125"), Decimal("4.0625"), Decimal("1.125"))
    assert [(r["rank"], r.customer_id, r.total_spent) for r in sorted(out["top_customers"].collect(), key=lambda r: r["rank"])] == [(1, 10, Decimal("185.31")), (2, 11, Decimal("11.11"))]
    assert "rejected" not in out


def test_commerce_etl_sets_malformed_lines_aside(spark, tmp_dir):
    good = "1,10,P1,2024-01-05,,2,100.00,0,1,Cash,Pending\n"
    paths = _triple(tmp_dir, good + "x,10,P1,2024-01-05,,2,100.00,0,1,Cash,Pending\n3,10,P1\n4,10,P1,2024-01-05,,2,1,0,1,Cash,Pending,more\n,10,P1,2024-01-05,,2,1,0,1,Cash,Pending\n")
    out = jobs.commerce_etl(spark, *paths, os.path.join(tmp_dir, "out"), quarantine=True)
    assert [r.order_id for r in out["orders"].collect()] == [1]
    counts = {r.table: (r.n_good, r.n_bad, r.file_path.rsplit("/", 1)[1]) for r in out["rejected"].collect()}
    assert counts == {"orders": (1, 4, "orders.csv"), "customers": (2, 0, "customers.csv"), "products": (1, 0, "products.csv")}


def test_item_similarities_job(spark, tmp_dir):
    ratings = os.path.join(tmp_dir, "ratings.dat")
    movies = os.path.join(tmp_dir, "movies.dat")
    rows = []
    for u in range(1, 8):
        rows += [f"{u}::1::5::0", f"{u}::2::5::0", f"{u}::3::{1 + u % 5}::0"]
    _write(ratings, "\n".join(rows) + "\n")
    _write(movies, "1::Toy Story (1995)::Animation\n2::Jumanji (1995)::Adventure\n")
    top = jobs.item_similarities(spark, ratings, movies, 1, os.path.join(tmp_dir, "sims"), 0.95, 5, 10).collect()
    assert [(r.item, r.title, r.strength) for r in top] == [(2, "Jumanji (1995)", 7)]
    assert abs(top[0].score - 1.0) < 1e-12


def test_small_text_jobs(spark, tmp_dir):
    g = os.path.join(tmp_dir, "graph.txt")
    n = os.path.join(tmp_dir, "names.txt")
    _write(g, "1 2 3 \n2 1\n3 1\n1 4\n4 1\n")
    _write(n, '1 "A"\n2 "B"\n3 "C"\n4 "D"\n')
    low = sorted((r.id, r.connections) for r in jobs.least_connected(spark, g, n).collect())
    assert low == [(2, 1), (3, 1), (4, 1)]
    log = os.path.join(tmp_dir, "access.log")
    _write(log, '1.1.1.1 - - [x] "GET /a HTTP/1.1" 200 1\n1.1.1.1 - - [x] "GET /b HTTP/1.0" 404 1\n')
    rep = jobs.access_log_report(spark, log)
    assert [(r.ip, r["count"]) for r in rep["ip"].collect()] == [("1.1.1.1", 2)]
    book = os.path.join(tmp_dir, "book.txt")
    _write(book, "It is a truth. A TRUTH universally\nacknowledged\n")
    wc = {r.word: r["count"] for r in jobs.word_count(spark, book).collect()}
    assert wc["truth"] == 2 and wc["a"] == 2
    cu = os.path.join(tmp_dir, "customers.csv")
    od = os.path.join(tmp_dir, "orders.csv")
    _write(cu, "customer_id,first_name\n1,A\n2,B\n3,C\n")
    _write(od, "order_id,customer_id,amount\n10,1,5.0\n11,1,6.0\n12,3,1.0\n")
    assert [r.first_name for r in jobs.customers_without_orders(spark, cu, od).collect()] == ["B"]
    t = os.path.join(tmp_dir, "u.data")
    nm = os.path.join(tmp_dir, "u.item")
    _write(t, "1\t10\t5\t0\n2\t10\t3\t0\n1\t20\t4\t0\n")
    _write(nm, "10|Café|x\n", encoding="iso-8859-1")
    pop = jobs.popular_items(spark, t, nm, k=2)
    assert [(r.item, r.title, r.n_ratings) for r in pop["most_rated"].orderBy("n_ratings", ascending=False).collect()] \
        == [(10, "Café", 2), (20, "Unknown", 1)]
