"""Readers: shop tables, fixed dimensions, ad-click lines and streams."""
