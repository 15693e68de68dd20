"""Stage compositions, driver-table role views, SQL oracles and the query registry."""
