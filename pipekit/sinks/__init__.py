"""Write modes, exports, layers and routing."""
