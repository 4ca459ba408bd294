"""Plans: the layered build (raw → silver → gold → marts), the staged
pipeline that materialises it, and the registered driver queries."""
