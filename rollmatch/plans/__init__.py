"""End-to-end jobs composed of the operators; the only place where table headings are named."""
