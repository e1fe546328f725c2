"""The registered queries, their inputs and the SQL that must agree with them."""
