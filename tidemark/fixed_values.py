"""Fixed values that results depend on, kept as plain text tables.

Nothing in this file is logic. Each block is a small table (well under 200
rows) with ``|`` between columns; ``rows()`` splits a block into tuples.
"""

from __future__ import annotations


def rows(block: str) -> list[tuple[str, ...]]:
    """Split a ``|`` separated text block into one tuple of strings per line."""
    return [
        tuple(cell.strip() for cell in line.split("|"))
        for line in block.strip().splitlines()
        if line.strip()
    ]


# Data sources. name | catalogue id | scale in metres | coverage | first day | bands
DATASETS = """
DAYMET | NASA/ORNL/DAYMET_V4        | 1000  | CONUS_HI_PR | 1980-01-01 | prcp srad swe tmax tmin vp
ERA5   | ECMWF/ERA5_LAND/DAILY_AGGR | 11132 | GLOBAL      | 1950-01-01 | temperature_2m temperature_2m_min temperature_2m_max total_precipitation_sum v_component_of_wind_10m u_component_of_wind_10m snowmelt_sum snowfall_sum snow_cover snow_depth total_evaporation_sum potential_evaporation_sum
"""

# Keys outside the DAYMET coverage, served by ERA5 alone.
ERA5_ONLY = """
denali
gates-of-the-arctic
glacier-bay
katmai
kenai-fjords
kobuk-valley
lake-clark
wrangell-st-elias
american-samoa
virgin-islands
"""

# Canonical variables. name | yearly reduction | source:unit in priority order
VARIABLES = """
tmax_c           | mean | DAYMET_tmax:C ERA5_temperature_2m_max:K
tmin_c           | mean | DAYMET_tmin:C ERA5_temperature_2m_min:K
tmean_c          | mean | ERA5_temperature_2m:K
prcp_mm          | sum  | DAYMET_prcp:mm ERA5_total_precipitation_sum:m
snow_depth_we_mm | mean | ERA5_snow_depth:m_we
snowfall_mm      | sum  | ERA5_snowfall_sum:m_we
snowmelt_mm      | sum  | ERA5_snowmelt_sum:m_we
snow_cover_pct   | mean | ERA5_snow_cover:pass
srad_wm2         | mean | DAYMET_srad:Wm2
swe_mm           | mean | DAYMET_swe:kgm2
vp_pa            | mean | DAYMET_vp:Pa
pet_mm           | sum  | ERA5_potential_evaporation_sum:m_neg
aet_mm           | sum  | ERA5_total_evaporation_sum:m_neg
"""

# Display metadata. variable | label | unit | slope unit | kind | decimals | description
VARIABLE_LABELS = """
tmean_c          | Mean temperature              | °F      | °F / yr   | temperature | 3 | Annual mean of daily mean near-surface temperature.
tmax_c           | Maximum temperature           | °F      | °F / yr   | temperature | 3 | Annual mean of daily maximum near-surface temperature.
tmin_c           | Minimum temperature           | °F      | °F / yr   | temperature | 3 | Annual mean of daily minimum near-surface temperature.
prcp_mm          | Precipitation                 | mm / yr | mm / yr²  | precip      | 2 | Annual total precipitation.
snowfall_mm      | Snowfall (water-equivalent)   | mm / yr | mm / yr²  | snow        | 2 | Annual total water-equivalent snowfall.
swe_mm           | Snow-water equivalent         | mm      | mm / yr   | snow        | 2 | Mean daily snow-water equivalent.
srad_wm2         | Shortwave radiation           | W/m²    | W/m² / yr | other       | 2 | Mean daily downwelling shortwave radiation.
vp_pa            | Vapour pressure               | Pa      | Pa / yr   | other       | 1 | Mean daily near-surface water-vapour pressure.
pet_mm           | Potential evapotranspiration  | mm / yr | mm / yr²  | other       | 2 | Annual total potential evapotranspiration (ERA5-Land).
aet_mm           | Actual evapotranspiration     | mm / yr | mm / yr²  | other       | 2 | Annual total actual evapotranspiration (ERA5-Land).
snow_cover_pct   | Snow cover                    | %       | % / yr    | snow        | 2 | Mean daily snow-cover fraction.
snow_depth_we_mm | Snow depth (water-equivalent) | mm      | mm / yr   | snow        | 2 | Mean daily snow depth expressed as water equivalent.
snowmelt_mm      | Snowmelt                      | mm / yr | mm / yr²  | snow        | 2 | Annual total snowmelt.
wind_speed_ms    | Wind speed                    | m/s     | m/s / yr  | other       | 3 | Mean daily 10-m wind speed.
"""

# Tokens that are units, not words, at the end of a variable name.
UNIT_SUFFIXES = "c mm pct ms wm2 pa"

# Variables shown first, in this order.
HEADLINE = "tmean_c tmax_c tmin_c prcp_mm"

# Temperature variables (levels in degrees Celsius).
TEMPERATURES = "tmean_c tmax_c tmin_c"

# Climatology periods, inclusive. first year | last year
PERIODS = """
1981 | 1995
1996 | 2010
2011 | 2025
"""

# Plausible range of annual values. variable | low | high
RANGE_BANDS = """
tmean_c          | -25.0  | 35.0
tmax_c           | -20.0  | 50.0
tmin_c           | -45.0  | 30.0
prcp_mm          | -0.001 | 8000.0
snowfall_mm      | -0.001 | 5000.0
snowmelt_mm      | -0.001 | 5000.0
swe_mm           | -0.001 | 3000.0
snow_depth_we_mm | -0.001 | 25000.0
snow_cover_pct   | 0.0    | 100.0
srad_wm2         | 40.0   | 500.0
vp_pa            | 50.0   | 3500.0
wind_speed_ms    | 0.0    | 25.0
pet_mm           | 0.0    | 8000.0
aet_mm           | -100.0 | 2500.0
"""

# Published warming over the record in degrees C. key | low | high | published source
WARMING_BOUNDS = """
yellowstone           | 0.4  | 2.5 | GYA Climate Assessment (gyclimate.org/ch3): ~1.4 °C since 1980s
denali                | 0.7  | 3.5 | Gonzalez et al. 2018: 4.3 ± 1.1 °C/century 1950–2010
everglades            | 0.0  | 2.5 | NOAA Climate at a Glance, Florida statewide: ~0.3 °F/dec post-1980
death-valley          | 0.5  | 3.0 | NWS Death Valley Climate Book: accelerated record-setting since 2010
olympic               | 0.2  | 2.5 | Washington State Climate Summary 2022 (statesummaries.ncics.org)
great-smoky-mountains | 0.0  | 2.5 | NOAA Climate at a Glance, NC/TN statewide post-1980
glacier               | 0.4  | 3.0 | NPS Glacier (nps.gov/glac): ~0.8 °F/decade since 1980
big-bend              | 0.4  | 3.0 | Texas State Climate Summary 2022 (statesummaries.ncics.org)
acadia                | 0.5  | 2.5 | NPS Acadia (nps.gov/acad): +3.4 °F since 1895, accelerating
hawaii-volcanoes      | -0.5 | 2.0 | Hawaii State Climate Summary 2022 (statesummaries.ncics.org)
grand-canyon          | 0.4  | 3.0 | Arizona State Climate Summary 2022: ~0.5 °F/decade post-1980
rocky-mountain        | 0.4  | 3.0 | Colorado State Climate Summary 2022 (statesummaries.ncics.org)
mount-rainier         | 0.2  | 2.5 | Washington State Climate Summary 2022 (statesummaries.ncics.org)
joshua-tree           | 0.4  | 3.0 | California State Climate Summary 2022 (statesummaries.ncics.org)
shenandoah            | 0.0  | 2.5 | Virginia State Climate Summary 2022 (statesummaries.ncics.org)
voyageurs             | 0.5  | 3.5 | Minnesota State Climate Summary 2022: strongest winter warming in CONUS
mesa-verde            | 0.4  | 3.0 | Colorado State Climate Summary 2022 (statesummaries.ncics.org)
crater-lake           | 0.2  | 2.5 | Oregon State Climate Summary 2022 (statesummaries.ncics.org)
sequoia               | 0.3  | 3.0 | California State Climate Summary 2022 (statesummaries.ncics.org)
gates-of-the-arctic   | 0.7  | 3.5 | Gonzalez et al. 2018 + Alaska State Climate Summary 2022
"""

# State and territory names. code | name
STATE_NAMES = """
AK | Alaska
AL | Alabama
AR | Arkansas
AS | American Samoa
AZ | Arizona
CA | California
CO | Colorado
CT | Connecticut
DE | Delaware
FL | Florida
GA | Georgia
HI | Hawaii
IA | Iowa
ID | Idaho
IL | Illinois
IN | Indiana
KS | Kansas
KY | Kentucky
LA | Louisiana
MA | Massachusetts
MD | Maryland
ME | Maine
MI | Michigan
MN | Minnesota
MO | Missouri
MS | Mississippi
MT | Montana
NC | North Carolina
ND | North Dakota
NE | Nebraska
NH | New Hampshire
NJ | New Jersey
NM | New Mexico
NV | Nevada
NY | New York
OH | Ohio
OK | Oklahoma
OR | Oregon
PA | Pennsylvania
PR | Puerto Rico
RI | Rhode Island
SC | South Carolina
SD | South Dakota
TN | Tennessee
TX | Texas
UT | Utah
VA | Virginia
VI | Virgin Islands
VT | Vermont
WA | Washington
WI | Wisconsin
WV | West Virginia
WY | Wyoming
"""

# Browse regions. region | state codes
REGIONS = """
Alaska     | AK
Pacific NW | WA OR
California | CA
Rockies    | MT WY ID CO SD ND
Southwest  | AZ UT NV NM TX
Midwest    | NE KS MO AR MN MI OH IN
East       | ME VA WV MD KY TN NC SC GA FL
Tropical   | HI AS VI PR
"""

# Diverging colour stops for z-scores. z | red | green | blue
STRIPE_STOPS = """
-3.0 | 5   | 48  | 97
-1.5 | 67  | 147 | 195
0.0  | 247 | 247 | 247
1.5  | 214 | 96  | 77
3.0  | 103 | 0   | 31
"""
STRIPE_MISSING = "#f7f7f7"

# Sequential colour stops for a value scaled to 0..1. position | red | green | blue
LABEL_STOPS = """
0.00 | 200 | 155 | 15
0.25 | 220 | 110 | 20
0.50 | 200 | 55  | 40
0.75 | 130 | 25  | 40
1.00 | 60  | 10  | 25
"""
LABEL_MISSING = "#8a8480"

# Keys with several disjoint units. key | unit names separated by ;
MULTIPART = """
saguaro         | Rincon Mountain District; Tucson Mountain District
channel-islands | Santa Cruz Island; Santa Rosa Island; San Miguel Island; Anacapa Island; Santa Barbara Island
kings-canyon    | Main Unit; Grant Grove
redwood         | Main Unit
american-samoa  | Tutuila Unit; Taʻū Unit; Ofu Unit
virgin-islands  | Main Unit
dry-tortugas    | Main Unit
congaree        | Main Unit
gulf-islands    | Florida District; Mississippi District
"""

# Names a unit carries in boundary layers. unit name | layer names separated by ;
ALIASES = """
Denali National Park               | Denali National Park and Preserve; Denali National Park
Gates of the Arctic National Park  | Gates of the Arctic National Park and Preserve; Gates of the Arctic National Park
Glacier Bay National Park          | Glacier Bay National Park and Preserve; Glacier Bay National Park
Katmai National Park               | Katmai National Park and Preserve; Katmai National Park
Lake Clark National Park           | Lake Clark National Park and Preserve; Lake Clark National Park
Wrangell-St. Elias National Park   | Wrangell-St. Elias National Park and Preserve; Wrangell-St. Elias National Park
Hawaii Volcanoes National Park     | Hawaii Volcanoes National Park; Hawai'i Volcanoes National Park
Haleakala National Park            | Haleakala National Park; Haleakalā National Park
Gateway Arch National Park         | Gateway Arch National Park; Jefferson National Expansion Memorial
Indiana Dunes National Park        | Indiana Dunes National Park; Indiana Dunes National Lakeshore
New River Gorge National Park      | New River Gorge National Park; New River Gorge National Park and Preserve; New River Gorge National River
White Sands National Park          | White Sands National Park; White Sands National Monument
"""

# The key registry with approximate centroids.
# key | unit name | states | latitude | longitude | area in square kilometres
REGISTRY = """
acadia                       | Acadia National Park                       | ME       |   44.35 |   -68.22 | 198
american-samoa               | National Park of American Samoa            | AS       |  -14.25 |  -170.68 | 35
arches                       | Arches National Park                       | UT       |   38.73 |  -109.59 | 310
badlands                     | Badlands National Park                     | SD       |   43.86 |  -102.34 | 982
big-bend                     | Big Bend National Park                     | TX       |   29.25 |  -103.25 | 3242
biscayne                     | Biscayne National Park                     | FL       |   25.48 |   -80.21 | 700
black-canyon-of-the-gunnison | Black Canyon of the Gunnison National Park | CO       |   38.57 |  -107.72 | 124
bryce-canyon                 | Bryce Canyon National Park                 | UT       |   37.59 |  -112.19 | 145
canyonlands                  | Canyonlands National Park                  | UT       |    38.2 |  -109.93 | 1366
capitol-reef                 | Capitol Reef National Park                 | UT       |   38.37 |  -111.27 | 979
carlsbad-caverns             | Carlsbad Caverns National Park             | NM       |   32.18 |  -104.44 | 189
channel-islands              | Channel Islands National Park              | CA       |   34.01 |  -119.42 | 1009
congaree                     | Congaree National Park                     | SC       |   33.79 |   -80.78 | 107
crater-lake                  | Crater Lake National Park                  | OR       |   42.94 |   -122.1 | 741
cuyahoga-valley              | Cuyahoga Valley National Park              | OH       |   41.28 |   -81.56 | 133
death-valley                 | Death Valley National Park                 | CA,NV    |    36.5 |   -117.1 | 13793
denali                       | Denali National Park                       | AK       |   63.33 |   -150.5 | 24585
dry-tortugas                 | Dry Tortugas National Park                 | FL       |   24.63 |   -82.87 | 262
everglades                   | Everglades National Park                   | FL       |   25.28 |    -80.9 | 6107
gates-of-the-arctic          | Gates of the Arctic National Park          | AK       |   67.78 |   -153.3 | 30448
gateway-arch                 | Gateway Arch National Park                 | MO       |   38.63 |   -90.19 | 0.3
glacier                      | Glacier National Park                      | MT       |   48.75 |  -113.75 | 4101
glacier-bay                  | Glacier Bay National Park                  | AK       |   58.67 |   -136.9 | 13287
grand-canyon                 | Grand Canyon National Park                 | AZ       |   36.05 |  -112.14 | 4926
grand-teton                  | Grand Teton National Park                  | WY       |   43.79 |  -110.68 | 1254
great-basin                  | Great Basin National Park                  | NV       |   38.98 |   -114.3 | 312
great-sand-dunes             | Great Sand Dunes National Park             | CO       |   37.73 |  -105.51 | 434
great-smoky-mountains        | Great Smoky Mountains National Park        | TN,NC    |   35.68 |   -83.53 | 2114
guadalupe-mountains          | Guadalupe Mountains National Park          | TX       |   31.92 |  -104.87 | 349
haleakala                    | Haleakala National Park                    | HI       |   20.72 |  -156.17 | 134
hawaii-volcanoes             | Hawaii Volcanoes National Park             | HI       |   19.38 |   -155.2 | 1348
hot-springs                  | Hot Springs National Park                  | AR       |   34.52 |   -93.05 | 22
indiana-dunes                | Indiana Dunes National Park                | IN       |   41.65 |   -87.05 | 61
isle-royale                  | Isle Royale National Park                  | MI       |    48.1 |   -88.55 | 2314
joshua-tree                  | Joshua Tree National Park                  | CA       |   33.88 |   -115.9 | 3218
katmai                       | Katmai National Park                       | AK       |    58.5 |   -155.0 | 19122
kenai-fjords                 | Kenai Fjords National Park                 | AK       |   59.92 |  -149.65 | 2711
kings-canyon                 | Kings Canyon National Park                 | CA       |    36.8 |  -118.55 | 1870
kobuk-valley                 | Kobuk Valley National Park                 | AK       |   67.55 |  -159.28 | 7085
lake-clark                   | Lake Clark National Park                   | AK       |   60.42 |  -153.42 | 16308
lassen-volcanic              | Lassen Volcanic National Park              | CA       |   40.49 |  -121.51 | 431
mammoth-cave                 | Mammoth Cave National Park                 | KY       |   37.19 |    -86.1 | 215
mesa-verde                   | Mesa Verde National Park                   | CO       |   37.18 |  -108.49 | 212
mount-rainier                | Mount Rainier National Park                | WA       |   46.85 |  -121.75 | 956
new-river-gorge              | New River Gorge National Park              | WV       |   37.88 |   -81.07 | 285
north-cascades               | North Cascades National Park               | WA       |    48.7 |   -121.2 | 2043
olympic                      | Olympic National Park                      | WA       |    47.8 |   -123.6 | 3734
petrified-forest             | Petrified Forest National Park             | AZ       |   34.91 |  -109.81 | 895
pinnacles                    | Pinnacles National Park                    | CA       |   36.49 |  -121.18 | 107
redwood                      | Redwood National Park                      | CA       |    41.3 |   -124.0 | 562
rocky-mountain               | Rocky Mountain National Park               | CO       |   40.34 |  -105.69 | 1076
saguaro                      | Saguaro National Park                      | AZ       |   32.25 |   -110.8 | 371
sequoia                      | Sequoia National Park                      | CA       |   36.49 |  -118.57 | 1636
shenandoah                   | Shenandoah National Park                   | VA       |   38.53 |   -78.35 | 802
theodore-roosevelt           | Theodore Roosevelt National Park           | ND       |   46.97 |  -103.45 | 285
virgin-islands               | Virgin Islands National Park               | VI       |   18.34 |   -64.73 | 60
voyageurs                    | Voyageurs National Park                    | MN       |    48.5 |   -92.88 | 883
white-sands                  | White Sands National Park                  | NM       |   32.78 |  -106.17 | 592
wind-cave                    | Wind Cave National Park                    | SD       |   43.62 |  -103.48 | 137
wrangell-st-elias            | Wrangell-St. Elias National Park           | AK       |   61.71 |  -142.98 | 33682
yellowstone                  | Yellowstone National Park                  | WY,MT,ID |    44.6 |   -110.5 | 8983
yosemite                     | Yosemite National Park                     | CA       |   37.83 |   -119.5 | 3081
zion                         | Zion National Park                         | UT       |    37.3 |  -113.05 | 593
"""
