"""State season windows, codes, class labels."""

#: State, first and last day of year of its season.
SEASONS = [
    ("AL", 121, 212), ("AR", 121, 212), ("AZ", 91, 181), ("CA", 152, 258), ("CO", 152, 258), ("CT", 121, 212),
    ("DE", 121, 212), ("FL", 121, 212), ("GA", 121, 212), ("IA", 121, 212), ("ID", 152, 258), ("IL", 121, 212),
    ("IN", 121, 212), ("KS", 91, 181), ("KY", 121, 212), ("LA", 121, 212), ("MA", 121, 212), ("MD", 121, 212),
    ("ME", 140, 243), ("MI", 140, 243), ("MN", 140, 243), ("MO", 121, 212), ("MS", 121, 212), ("MT", 152, 258),
    ("NC", 121, 212), ("ND", 152, 258), ("NE", 152, 258), ("NH", 140, 243), ("NJ", 121, 212), ("NM", 91, 181),
    ("NV", 152, 258), ("NY", 121, 212), ("OH", 121, 212), ("OK", 91, 181), ("OR", 152, 258), ("PA", 121, 212),
    ("RI", 121, 212), ("SC", 121, 212), ("SD", 152, 258), ("TN", 121, 212), ("TX", 91, 181), ("UT", 152, 258),
    ("VA", 121, 212), ("VT", 140, 243), ("WA", 152, 258), ("WI", 140, 243), ("WV", 121, 212), ("WY", 152, 258),
]
#: Unknown, wildfire, and wildfire that was allowed to burn.
FIRE_TYPES = (0, 1, 3)
#: Fill, dilated cloud, cloud, cloud shadow, snow and water bits of a quality pixel.
QA_BITS = (0, 1, 3, 4, 5, 7)
SCALE, OFFSET = 0.0000275, -0.2
MAX_CLOUD = 80.0
#: First and last supported year of a fire.
YEARS = (1986, 2020)
SQUARE_METRES_PER_ACRE = 4046.8564224
#: Split threshold: acres of bounding box, shared by the workers.
SPLIT_ACRES = 300_000
CBI_RANGE, CBI_BINS = (0.0, 3.0), 60
COVERS = ("Water", "Developed", "Barren", "Forest", "Shrubland", "Grassland", "Agriculture", "Wetland")
SEVERITY = {1: "Unburned to Low", 2: "Low", 3: "Moderate", 4: "High", 5: "Increased Greenness", 6: "Non-Mapped"}
PREDICTORS = ("def", "lat", "rbr", "dmirbi", "dndvi", "post_mirbi")
