"""Per-region settings of the catalogue sync."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Region:
    """What differs between one region's sync and another's.

    ``regional`` picks the selection rules: a regional sync joins base and
    region rows and needs every parent to exist; the generic one works from the
    ids changed in the region's rows alone.
    """

    code: str
    agency_id: int | None
    streaming: int
    download: int
    rental: int | None = None
    regional: bool = True
    alt_titles: bool = False
    match_sets_mv_rights: bool = True
    match_sets_status: bool = True

    @property
    def services(self) -> tuple[int, ...]:
        """Every service whose right makes an album playable in the region."""
        return tuple(s for s in (self.streaming, self.download, self.rental) if s is not None)


# Agency and service ids of the two regions.
VNM = Region("VNM", agency_id=19862, streaming=715, download=714, match_sets_mv_rights=False)
JPN = Region("JPN", agency_id=20382, streaming=716, download=717, rental=718, alt_titles=True)


def generic_region(code: str | None = None) -> Region:
    """Settings of the generic sync: any region code, the VNM service ids."""
    code = code or VNM.code
    return Region(
        code,
        agency_id=VNM.agency_id if code == VNM.code else None,
        streaming=VNM.streaming,
        download=VNM.download,
        regional=False,
        match_sets_status=False,
    )
