"""Writers of panels, side outputs, exports and keyed tables."""
