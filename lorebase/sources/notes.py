"""A small documentation set for the tables at hand, and questions about them."""

from __future__ import annotations

# (doc_id, doc_type, title, content, tables, columns, tags).
#
# Fixed values, marked where they stand: names and types of the columns of customers and orders, the words of the
# order status, and the definitions of revenue, conversion, churn and the fiscal year, since business views and
# metrics are checked by them. Everything else describes the tables of this project.
BUSINESS_DOCS = [
    (
        "table_of_customers",
        "schema",
        "Columns of customers",
        "Table: customers\n"
        "Built from customer, nation, region and orders; each c_custkey comes once.\n\n"
        "Columns:\n"
        # Fixed values: names and types.
        "- customer_id (BIGINT): c_custkey\n"
        "- customer_name (STRING): c_name\n"
        "- email (STRING): Always empty here, the source has no mail addresses\n"
        "- phone (STRING): Always empty here as well\n"
        "- registration_date (DATE): Date of the first order\n"
        "- customer_segment (STRING): c_mktsegment\n"
        "- region (STRING): r_name, by way of the nation\n"
        "- is_active (BOOLEAN): Not churned\n"
        "- lifetime_value (DOUBLE): Sum over completed orders\n",
        ["customers"],
        [
            "customer_id", "customer_name", "email", "phone", "registration_date", "customer_segment", "region", "is_active",
            "lifetime_value",
        ],
        ["columns", "customers"],
    ),
    (
        "table_of_orders",
        "schema",
        "Columns of orders",
        "Table: orders\n"
        "Built from orders and lineitem; each o_orderkey comes once.\n\n"
        "Columns:\n"
        # Fixed values: names and types.
        "- order_id (BIGINT): o_orderkey\n"
        "- customer_id (BIGINT): o_custkey\n"
        "- order_date (DATE): o_orderdate without its time\n"
        "- order_amount (DOUBLE): o_totalprice\n"
        "- order_status (STRING): completed for F, pending for O, cancelled for P\n"
        "- product_category (STRING): p_type of the line with the highest price\n"
        "- quantity (INT): l_quantity over all lines\n"
        "- discount_applied (DOUBLE): l_discount, weighted by price\n"
        "- shipping_region (STRING): Region of the customer\n",
        ["orders"],
        [
            "order_id", "customer_id", "order_date", "order_amount", "order_status", "product_category", "quantity", "discount_applied",
            "shipping_region",
        ],
        ["columns", "orders"],
    ),
    (
        "how_revenue_counts",
        "metric",
        "Working out total revenue",
        "Total revenue is order_amount over completed orders; o_orderstatus has to be F.\n\n"
        "SELECT round(sum(order_amount), 2) AS revenue\nFROM orders\nWHERE order_status = 'completed'\n\n"
        "The 80 months of data hold no refunds.\n",
        ["orders"],
        ["order_amount", "order_status"],
        ["formula", "amounts"],
    ),
    (
        "how_conversion_counts",
        "metric",
        "Working out the conversion rate",
        "Metric of conversion: of a hundred customers, so many have a completed order. Customers without orders stay in.\n\n"
        "SELECT round(count(DISTINCT o.customer_id) * 100.0 / count(DISTINCT c.customer_id), 4) AS conversion_rate\n"
        "FROM customers c\n"
        "LEFT JOIN orders o ON c.customer_id = o.customer_id AND o.order_status = 'completed'\n",
        ["customers", "orders"],
        ["customer_id", "order_status"],
        ["formula", "customers"],
    ),
    (
        "ask_best_customers",
        "query_example",
        "Top ten customers by revenue",
        "Who are the top customers by revenue, and how many orders are behind it\n\n"
        "SELECT c.customer_id, c.customer_name, c.customer_segment,\n"
        "  round(sum(o.order_amount), 2) AS total_revenue, count(o.order_id) AS order_count\n"
        "FROM orders o JOIN customers c ON o.customer_id = c.customer_id\n"
        "WHERE o.order_status = 'completed'\n"
        "GROUP BY c.customer_id, c.customer_name, c.customer_segment\n"
        "ORDER BY total_revenue DESC, c.customer_id LIMIT 10\n",
        ["customers", "orders"],
        ["customer_id", "customer_name", "customer_segment", "order_amount", "order_id", "order_status"],
        ["example", "ranking"],
    ),
    (
        "when_the_year_turns",
        "business_logic",
        "The fiscal year begins in January",
        # Fixed value: the calendar year.
        "The fiscal year begins on 1 January. Its quarters are those of the calendar, 1995 to 2001 in this data.\n",
        [],
        [],
        ["dates"],
    ),
    (
        "how_churn_counts",
        "business_logic",
        "Customers that count as churned",
        # 60 and 90 days.
        "A customer counts as churned when the last order_date lies more than 90 days before the last day of the data.\n"
        "From 60 to 90 days the customer is at risk.\n",
        ["customers", "orders"],
        ["customer_id", "order_date"],
        ["dates", "customers"],
    ),
    (
        "table_of_parts",
        "glossary",
        "Parts and lines",
        "lineitem has a row per part of an order, told apart by l_linenumber. A part's p_type is what reports call its product line.\n",
        ["lineitem", "part"],
        ["l_linenumber", "p_type"],
        ["columns", "parts"],
    ),
]
BUSINESS_DOC_COLUMNS = "doc_id string, doc_type string, title string, content string, tables array<string>, columns array<string>, tags array<string>"

BUSINESS_QUESTIONS = [
    ("q1", "How is total revenue worked out?"),
    ("q2", "Who are the top ten customers by revenue?"),
    ("q3", "Which columns does the customers table have?"),
    ("q4", "When does a customer count as churned?"),
    ("q5", "What is the conversion rate metric?"),
    ("q6", "When does the fiscal year begin?"),
    ("q7", "   "),
]
