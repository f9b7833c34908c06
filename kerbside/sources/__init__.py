"""Reading source files and the stored layers."""
